"""Silver: reusable per-player building blocks.

``wallet_profile`` answers the per-player money questions in one pass over the transactions; the
single models are projections of it, so there is one definition of each figure. Where only some of
its columns are asked for, the others are not computed.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wagerlens.functions.scalars import is_type, safe_ratio, signed_amount, sum_of, whole_days
from wagerlens.operators.skew import running_total
from wagerlens.params import DEFAULTS, Params
from wagerlens.schemas import MONEY, TOTAL


def players_conformed(stg_players: DataFrame) -> DataFrame:
    """Lower-case e-mail: a normalization, not a dedup."""
    return stg_players.withColumn("email", F.lower("email"))


def first_deposit(wallet: DataFrame) -> DataFrame:
    """The real first deposit of each depositor."""
    return wallet.where("n_deposits > 0").select(
        "player_id", "first_deposit_ts", F.col("n_deposits").alias("deposit_count"), "total_deposits"
    )


def qualified_ftd(wallet: DataFrame) -> DataFrame:
    """Depositors, and whether they also bet the baseline."""
    return wallet.where("n_deposits > 0").select("player_id", "first_deposit_ts", "total_bets", "is_qualified")


def claim_rank() -> Column:
    """Sort key of a claim row: highest CPA, then lowest affiliate, then country to break ties."""
    return F.struct(
        F.col("cpa_value").isNull().alias("no_cpa"),
        (-F.col("cpa_value")).alias("minus_cpa"),
        F.col("affiliate_id"),
        F.col("country"),
    )


def winning_claims(stg_aff: DataFrame) -> DataFrame:
    """One claiming affiliate per player, before any gate.

    The winner is a minimum, so each map task sends one row per player: a player with very many
    rows costs no more to shuffle than any other.
    """
    best = stg_aff.where("ftd > 0").groupBy("player_id").agg(F.min(claim_rank()).alias("best"))
    return best.select(
        "player_id",
        F.col("best.affiliate_id").alias("affiliate_id"),
        F.col("best.country").alias("acquisition_country"),
        (-F.col("best.minus_cpa")).cast(MONEY).alias("cpa_value"),
    )


def affiliate_attribution(qualified: DataFrame, stg_aff: DataFrame) -> DataFrame:
    """One affiliate per *qualified* player; ``qualified`` is any frame with player_id, is_qualified."""
    return winning_claims(stg_aff).join(qualified.where("is_qualified").select("player_id"), "player_id")


def _financial_sums() -> list[Column]:
    return [
        sum_of("deposit").alias("total_deposits"),
        sum_of("withdraw").alias("total_withdrawals"),
        sum_of("bet").alias("total_bets"),
        F.count_if(is_type("deposit")).alias("n_deposits"),
        F.count_if(is_type("withdraw")).alias("n_withdrawals"),
        F.count_if(is_type("bet")).alias("n_bets"),
    ]


FINANCIALS = (
    "player_id", "total_deposits", "total_withdrawals", "total_bets",
    "net_deposit", "bet_ratio", "n_deposits", "n_withdrawals", "n_bets",
)


def _with_financial_ratios(sums: DataFrame) -> DataFrame:
    return sums.withColumns(
        {
            "net_deposit": (F.col("total_deposits") - F.col("total_withdrawals")).cast(TOTAL),
            "bet_ratio": safe_ratio(F.col("total_bets"), F.col("total_deposits")),
        }
    )


def player_financials(wallet: DataFrame) -> DataFrame:
    """Sums, counts and ratios of every player with a movement."""
    return wallet.select(*FINANCIALS)


def player_activity(stg_sessions: DataFrame) -> DataFrame:
    """Session rollup. The distinct counts shuffle on (player, value), so no player is one task."""
    return (
        stg_sessions.groupBy("player_id")
        .agg(
            F.count("*").alias("session_count"),
            F.count_distinct("ip").alias("distinct_ips"),
            F.count_distinct("device").alias("distinct_devices"),
            F.min("session_ts").alias("first_session_ts"),
            F.max("session_ts").alias("last_session_ts"),
        )
        .withColumn("active_span_days", whole_days(F.col("first_session_ts"), F.col("last_session_ts")))
    )


LEDGER = (
    "transaction_id", "player_id", "txn_ts", "transaction_type", "amount", "signed_amount", "running_balance",
)


def player_ledger(stg_tx: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """Every movement with the wallet balance after it, in (time, id) order."""
    signed = stg_tx.withColumn("signed_amount", signed_amount())
    balanced = running_total(
        signed, "player_id", ["txn_ts", "transaction_id"], F.col("signed_amount"), "running_balance",
        params.chunk_rows,
    )
    return balanced.withColumn("running_balance", F.col("running_balance").cast(TOTAL)).select(*LEDGER)


def opening_movement(tx: DataFrame) -> DataFrame:
    """(player_id, first_type): type of the first row in (time, id) order; a minimum, not a sort."""
    return (
        tx.groupBy("player_id")
        .agg(F.min(F.struct("txn_ts", "transaction_id", "transaction_type")).alias("head"))
        .select("player_id", F.col("head.transaction_type").alias("first_type"))
    )


def round_deposit_count(unit: int) -> Column:
    return F.count_if(is_type("deposit") & (F.col("amount") % F.lit(Decimal(unit)) == 0))


def wallet_profile(stg_tx: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """The per-player money facts in one aggregation over the transactions.

    Financials, first and qualified deposit and round deposits share a key and a source: one
    scan, one shuffle of pre-combined rows. All of it hash-aggregates, since every running value
    has a fixed width. The opening movement has not, hence ``opening_movement`` stays apart: it
    sorts, but only its own four columns, and lands partitioned by player like this frame.
    """
    sums = stg_tx.groupBy("player_id").agg(
        *_financial_sums(),
        F.min(F.when(is_type("deposit"), F.col("txn_ts"))).alias("first_deposit_ts"),
        round_deposit_count(params.structuring_unit).alias("n_round"),
    )
    enough = F.col("total_bets") >= F.lit(params.qualified_baseline)
    return _with_financial_ratios(sums).select(
        *FINANCIALS, "first_deposit_ts", ((F.col("n_deposits") > 0) & enough).alias("is_qualified"), "n_round"
    )


def player_wallet(stg_tx: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """``wallet_profile`` with the type of the opening movement: all that Gold asks of a player's money.

    The daily run stores it once; every Silver and Gold table about money is a projection of it. Both sides
    are grouped by player, so the join moves nothing.
    """
    return wallet_profile(stg_tx, params).join(opening_movement(stg_tx), "player_id", "left")


def affiliate_profile(stg_aff: DataFrame) -> DataFrame:
    """(player_id, has_claim, n_countries): what the affiliate rows say about a player."""
    return stg_aff.groupBy("player_id").agg(
        F.coalesce(F.bool_or(F.col("ftd") > 0), F.lit(False)).alias("has_claim"),
        F.count_distinct("country").alias("n_countries"),
    )
