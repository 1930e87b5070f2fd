"""Gold: the star schema served to reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wagerlens.functions.scalars import safe_ratio
from wagerlens.params import DEFAULTS, Params
from wagerlens.plans import signals, silver
from wagerlens.schemas import CONTRACTS, MONEY, TOTAL


def _shaped(df: DataFrame, table: str) -> DataFrame:
    """Columns in contract order and type (widening only; checked again on write)."""
    return df.select(*[F.col(f.name).cast(f.dataType) for f in CONTRACTS[table].fields])


def dim_date(stg_tx: DataFrame, stg_sessions: DataFrame) -> DataFrame:
    """One row per day between the first and the last event."""
    events = stg_tx.select(F.col("txn_ts").alias("ts")).union(stg_sessions.select(F.col("session_ts").alias("ts")))
    bounds = events.agg(F.to_date(F.min("ts")).alias("d0"), F.to_date(F.max("ts")).alias("d1"))
    day = F.col("date_day")
    days = bounds.where("d0 is not null").select(
        F.explode(F.sequence("d0", "d1", F.expr("interval 1 day"))).alias("date_day")
    )
    return _shaped(
        days.select(
            day,
            F.year(day).alias("year"), F.quarter(day).alias("quarter"), F.month(day).alias("month"),
            F.day(day).alias("day"),
            F.dayofweek(day).alias("day_of_week"),  # 1 = Sunday
            F.date_format(day, "EEEE").alias("day_name"),
            F.date_format(day, "yyyy-MM").alias("year_month"),
            F.dayofweek(day).isin(1, 7).alias("is_weekend"),
        ),
        "dim_date",
    )


def dim_player(conformed: DataFrame, wallet: DataFrame, claims: DataFrame) -> DataFrame:
    """Player dimension (current attributes only).

    ``claims`` has one affiliate per player: all winning claims, or those of qualified players only. The gate on
    qualification is a condition on the joined row, so both give the same dimension.
    """
    credited = F.coalesce(F.col("is_qualified"), F.lit(False))
    joined = (
        conformed.join(wallet.select("player_id", "first_deposit_ts", "is_qualified", "n_deposits"), "player_id", "left")
        .join(claims.select("player_id", "affiliate_id", "acquisition_country"), "player_id", "left")
    )
    return _shaped(
        joined.select(
            "player_id", "email", "city",
            F.col("created_at").alias("registered_at"),
            credited.alias("is_qualified_ftd"),
            "first_deposit_ts",
            F.when(credited, F.col("affiliate_id")).alias("acquisition_affiliate_id"),
            F.when(credited, F.col("acquisition_country")).alias("acquisition_country"),
            (F.coalesce(F.col("n_deposits"), F.lit(0)) == 1).alias("is_one_and_done"),
        ),
        "dim_player",
    )


def dim_affiliate(stg_aff: DataFrame) -> DataFrame:
    """Distinct players and countries per affiliate, and its most frequent country.

    One scan counts an affiliate's rows by country and by player at once. Both kinds of count combine before the
    shuffle and shuffle on two keys, so a dominant affiliate is not in one task; what is left of it are partial sums.
    """
    cells = stg_aff.groupingSets(
        [["affiliate_id", "country"], ["affiliate_id", "player_id"]], "affiliate_id", "country", "player_id"
    ).agg(F.count("*").alias("n"), (F.grouping("player_id") == 1).alias("is_country"))
    country = F.when(F.col("is_country"), F.col("country"))
    # Most rows first, then country name; a NULL country sorts first, as in an ascending sort.
    top = F.min(F.when(F.col("is_country"), F.struct((-F.col("n")).alias("minus_n"), F.col("country").alias("country"))))
    rows = cells.groupBy("affiliate_id").agg(
        F.count(F.when(~F.col("is_country"), F.col("player_id"))).alias("n_players_claimed"),
        F.count(country).alias("n_acquisition_countries"),
        top.alias("top"),
    )
    return _shaped(rows.withColumn("primary_country", F.col("top.country")), "dim_affiliate")


def fct_transactions(ledger: DataFrame) -> DataFrame:
    return _shaped(ledger.withColumn("txn_date", F.to_date("txn_ts")), "fct_transactions")


def fct_sessions(stg_sessions: DataFrame) -> DataFrame:
    return _shaped(stg_sessions.withColumn("session_date", F.to_date("session_ts")), "fct_sessions")


def agg_affiliate_performance(stg_aff: DataFrame, wallet: DataFrame) -> DataFrame:
    """Per attributed affiliate: qualified players, CPA, revenue, ROI and unqualified claims.

    Claims are reduced to (player, affiliate) pairs once, the winner is marked among a player's pairs, and
    one join to the wallet decides both the qualified and the ghost side. A NULL player claims nothing.
    """
    pairs = (
        stg_aff.where("ftd > 0 and player_id is not null")
        .groupBy("player_id", "affiliate_id")
        .agg(F.min(silver.claim_rank()).alias("rank"))
    )
    # At most one row per affiliate in a player's group.
    marked = pairs.withColumn("wins", F.col("rank") == F.min("rank").over(Window.partitionBy("player_id")))
    joined = marked.join(wallet.select("player_id", "is_qualified", "net_deposit"), "player_id", "left")
    credited = F.col("wins") & F.coalesce(F.col("is_qualified"), F.lit(False))
    rows = (
        joined.groupBy("affiliate_id")
        .agg(
            F.count_if(credited).alias("qualified_ftds"),
            F.sum(F.when(credited, (-F.col("rank.minus_cpa")).cast(MONEY))).cast(TOTAL).alias("cpa_owed"),
            F.sum(F.when(credited, F.col("net_deposit"))).cast(TOTAL).alias("real_revenue"),
            F.count_if(~F.coalesce(F.col("is_qualified"), F.lit(False))).alias("ghost_ftds"),
        )
        .where("qualified_ftds > 0")  # an affiliate with nothing but ghosts is not listed
    )
    return _shaped(rows.withColumn("roi", safe_ratio(F.col("real_revenue"), F.col("cpa_owed"))), "agg_affiliate_performance")


def fct_fraud_signals(
    stg_players: DataFrame, wallet: DataFrame, activity: DataFrame, stg_aff: DataFrame, params: Params = DEFAULTS
) -> DataFrame:
    """Fraud profile: what each source says about a player (``wallet`` with the opening movement), joined."""
    scored = signals.score_players(
        signals.with_registration_burst(stg_players, params), wallet, activity, silver.affiliate_profile(stg_aff), params
    )
    return _shaped(scored, "fct_fraud_signals")
