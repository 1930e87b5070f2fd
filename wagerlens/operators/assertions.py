"""Business assertions: each returns the rows that break a rule."""

from __future__ import annotations

from datetime import datetime
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wagerlens.functions.scalars import one_row
from wagerlens.operators.skew import lookup_join, running_total
from wagerlens.params import DEFAULTS, Params
from wagerlens.plans.signals import risk_score_rule
from wagerlens.plans.silver import opening_movement
from wagerlens.schemas import TOTAL


# Row rules as conditions that are true for a failing row.
AMOUNT_NOT_POSITIVE = "amount <= 0"
NEGATIVE_COUNTS = "clicks < 0 or registrations < 0 or ftd < 0 or cpa_value < 0"
FTD_ABOVE_REGISTRATIONS = "ftd > registrations"
REGISTRATIONS_ABOVE_CLICKS = "registrations > clicks"


def amount_positive(stg_tx: DataFrame) -> DataFrame:
    return stg_tx.where(AMOUNT_NOT_POSITIVE).select("transaction_id", "amount")


def counts_non_negative(stg_aff: DataFrame) -> DataFrame:
    return stg_aff.where(NEGATIVE_COUNTS).select(
        "affiliate_id", "player_id", "clicks", "registrations", "ftd", "cpa_value"
    )


def no_future_timestamps(stg_sessions: DataFrame, stg_tx: DataFrame, as_of: datetime) -> DataFrame:
    def late(model: str, df: DataFrame, key: str, ts: str) -> DataFrame:
        return df.where(F.col(ts) > F.lit(as_of).cast("timestamp")).select(
            F.lit(model).alias("model"), F.col(key).alias("id"), F.col(ts).alias("ts")
        )

    return late("stg_sessions", stg_sessions, "session_id", "session_ts").union(
        late("stg_transactions", stg_tx, "transaction_id", "txn_ts")
    )


def ftd_within_registrations(stg_aff: DataFrame) -> DataFrame:
    return stg_aff.where(FTD_ABOVE_REGISTRATIONS).select("affiliate_id", "player_id", "ftd", "registrations")


def registrations_within_clicks(stg_aff: DataFrame) -> DataFrame:
    return stg_aff.where(REGISTRATIONS_ABOVE_CLICKS).select("affiliate_id", "player_id", "registrations", "clicks")


def first_transaction_is_deposit(ledger: DataFrame) -> DataFrame:
    return (
        opening_movement(ledger).withColumnRenamed("first_type", "transaction_type")
        .where("transaction_type != 'deposit'")
    )


def no_transaction_before_created(stg_tx: DataFrame, players: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """Movements earlier than midnight (UTC) of the registration day."""
    joined = lookup_join(
        stg_tx.select("transaction_id", "player_id", "txn_ts"),
        players.select("player_id", "created_at"),
        "player_id", ["transaction_id"], params.chunk_rows, how="inner",
    )
    return joined.where(F.col("txn_ts") < F.col("created_at").cast("timestamp")).select(
        "transaction_id", "player_id", "txn_ts", "created_at"
    )


def qualified_has_deposit_and_baseline(qualified: DataFrame, baseline: Decimal = DEFAULTS.qualified_baseline) -> DataFrame:
    broken = F.col("first_deposit_ts").isNull() | (F.col("total_bets") < F.lit(baseline))
    return qualified.where(F.col("is_qualified") & broken).select("player_id", "total_bets")


def cpa_only_for_qualified(performance: DataFrame, attribution: DataFrame) -> DataFrame:
    totals = one_row(
        performance.agg(F.sum("qualified_ftds").alias("agg_total")),
        attribution.agg(F.count_distinct("player_id").alias("attr_total")),
    )
    return totals.where("agg_total != attr_total")


def every_player_has_profile(dim_player: DataFrame, fraud: DataFrame) -> DataFrame:
    return dim_player.select("player_id").join(fraud.select("player_id"), "player_id", "left_anti")


def risk_score_matches_flags(fraud: DataFrame) -> DataFrame:
    return fraud.where(F.col("risk_score") != risk_score_rule()).select("player_id", "risk_score")


def running_balance_reconciles(fct_tx: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    again = running_total(
        fct_tx, "player_id", ["txn_ts", "transaction_id"], F.col("signed_amount"), "recomputed", params.chunk_rows
    ).withColumn("recomputed", F.col("recomputed").cast(TOTAL))
    return again.where("running_balance != recomputed").select("transaction_id", "running_balance", "recomputed")
