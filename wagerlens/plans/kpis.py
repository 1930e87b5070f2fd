"""Dashboard measures over the Gold tables. Facts are reduced per player before any join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wagerlens.functions.scalars import one_row, safe_ratio, share, sum_of
from wagerlens.params import DEFAULTS, Params
from wagerlens.schemas import CORE_SIGNALS, SECONDARY_SIGNALS, TOTAL


def _sliced(df: DataFrame, where: Column | None) -> DataFrame:
    return df if where is None else df.where(where)


def kpi_fraud(fraud: DataFrame, where: Column | None = None, params: Params = DEFAULTS) -> DataFrame:
    """Fraud cards. Suspicious = at least one core signal."""
    high = F.col("risk_score") >= params.high_risk_score
    return _sliced(fraud, where).agg(
        F.count("*").alias("players_scanned"),
        F.count_if(F.col("risk_score") >= 1).alias("suspicious_accounts"),
        share(F.count_if(F.col("risk_score") >= 1), F.count("*")).alias("pct_suspicious"),
        F.sum("value_at_risk").alias("value_at_risk"),
        F.sum(F.when(high, F.col("value_at_risk"))).alias("high_risk_value_at_risk"),
        F.avg("risk_score").alias("avg_risk_score"),
    )


def investigation(fraud: DataFrame, dim_player: DataFrame) -> DataFrame:
    """Accounts under investigation, most suspicious first."""
    return (
        fraud.join(dim_player.select("player_id", "city", "acquisition_country"), "player_id")
        .select("player_id", "city", "acquisition_country", "risk_tier", "risk_score", "value_at_risk")
        .orderBy(F.desc("risk_score"), F.desc("value_at_risk"), "player_id")
    )


def by_signal(fraud: DataFrame) -> DataFrame:
    """Players flagged per signal, core signals first."""
    names = CORE_SIGNALS + SECONDARY_SIGNALS
    place = F.array_position(F.array(*[F.lit(n) for n in names]), F.col("signal"))
    return (
        fraud.agg(*[F.count_if(n).alias(n) for n in names])
        .unpivot([], list(names), "signal", "players_flagged")
        .withColumn("position", place)
        .withColumn("signal_group", F.when(place <= len(CORE_SIGNALS), "core").otherwise("secondary"))
        .orderBy("position")
    )


def var_by_country(fraud: DataFrame, dim_player: DataFrame) -> DataFrame:
    return (
        fraud.select("player_id", "value_at_risk")
        .join(dim_player.select("player_id", "acquisition_country"), "player_id")
        .groupBy("acquisition_country").agg(F.sum("value_at_risk").alias("value_at_risk"))
    )


def kpi_acquisition(dim_player: DataFrame, fct_tx: DataFrame, performance: DataFrame) -> DataFrame:
    """Acquisition cards. Active = has a transaction; one-and-done is a share of depositors."""
    people = dim_player.agg(
        F.count("*").alias("registered_players"),
        F.count("first_deposit_ts").alias("depositors"),
        F.count_if("is_one_and_done").alias("one_and_done"),
    )
    money = fct_tx.agg(sum_of("bet").alias("turnover"), F.count_distinct("player_id").alias("active_players"))
    revenue = performance.agg(F.sum("real_revenue").alias("revenue"))
    return one_row(people, money, revenue).select(
        "registered_players",
        "depositors",
        share(F.col("depositors"), F.col("registered_players")).alias("ftd_rate"),
        "turnover",
        safe_ratio(F.col("revenue").cast(TOTAL), F.col("active_players")).alias("arpu"),
        share(F.col("one_and_done"), F.col("depositors")).alias("pct_one_and_done"),
    )


def retention(fct_tx: DataFrame) -> DataFrame:
    """Per calendar month from the first movement to the last: players active, and those active the month before too.

    Movements become distinct (player, month) pairs first, so a player's window holds at most
    one row per month, and the closing window one row per month in all. A month without a movement
    has a row too: nobody was active, and of those active before it nobody stayed.
    """
    month = F.trunc("txn_date", "month")
    pairs = fct_tx.where("txn_date is not null").select("player_id", month.alias("month")).distinct()
    previous = F.lag("month").over(Window.partitionBy("player_id").orderBy("month"))
    monthly = (
        pairs.withColumn("returned", previous == F.add_months("month", -1))
        .groupBy("month").agg(F.count("*").alias("active"), F.count_if("returned").alias("returned"))
    )
    bounds = monthly.agg(F.min("month").alias("a"), F.max("month").alias("b")).where("a is not null")
    calendar = bounds.select(F.explode(F.sequence("a", "b", F.expr("interval 1 month"))).alias("month"))
    none = F.lit(0).cast("bigint")
    dense = calendar.join(monthly, "month", "left").select(
        "month", F.coalesce("active", none).alias("active_players"), F.coalesce("returned", none).alias("retained_players")
    )
    before = F.coalesce(F.lag("active_players").over(Window.orderBy("month")), none)
    return dense.withColumn("previous_active", before).select(
        F.date_format("month", "yyyy-MM").alias("year_month"),
        "active_players", "previous_active", "retained_players",
        share(F.col("retained_players"), F.col("previous_active")).alias("retention_rate"),
    )


def _money_per_player(fct_tx: DataFrame) -> DataFrame:
    return fct_tx.groupBy("player_id").agg(
        sum_of("deposit").alias("deposits"), sum_of("withdraw").alias("withdrawals"), sum_of("bet").alias("bets")
    )


def acquisition_by_country(dim_player: DataFrame, fct_tx: DataFrame) -> DataFrame:
    """Per acquisition country; unattributed players form the NULL country, without revenue."""
    money = _money_per_player(fct_tx).select("player_id", (F.col("deposits") - F.col("withdrawals")).alias("net"))
    rows = dim_player.join(money, "player_id", "left").groupBy("acquisition_country").agg(
        F.count("*").alias("registered_players"),
        F.count("first_deposit_ts").alias("depositors"),
        F.count("net").alias("active_players"),
        F.sum(F.when(F.col("acquisition_affiliate_id").isNotNull(), F.col("net"))).alias("revenue"),
    )
    return rows.select(
        "acquisition_country", "registered_players", "depositors",
        share(F.col("depositors"), F.col("registered_players")).alias("ftd_rate"),
        safe_ratio(F.col("revenue").cast(TOTAL), F.col("active_players")).alias("arpu"),
    )


def _affiliate_ratios(df: DataFrame) -> DataFrame:
    claims = F.col("ghost_ftds") + F.col("qualified_ftds")
    return df.withColumn("ghost_rate", share(F.col("ghost_ftds"), claims)).withColumn(
        "roi", safe_ratio(F.col("real_revenue").cast(TOTAL), F.col("cpa_owed").cast(TOTAL))
    )


def kpi_affiliate(performance: DataFrame) -> DataFrame:
    """Affiliate cards; ghost rate is over all claimed players."""
    return _affiliate_ratios(
        performance.agg(*[F.sum(c).alias(c) for c in ("qualified_ftds", "ghost_ftds", "cpa_owed", "real_revenue")])
    )


def affiliate_detail(performance: DataFrame) -> DataFrame:
    """One line per affiliate with qualified against ghost players."""
    return _affiliate_ratios(performance).orderBy("affiliate_id")


def kpi_financial(fct_tx: DataFrame, where: Column | None = None) -> DataFrame:
    """Financial cards; the house margin is net over deposits."""
    row = _sliced(fct_tx, where).agg(
        sum_of("deposit").alias("total_deposits"),
        sum_of("withdraw").alias("total_withdrawals"),
        sum_of("bet").alias("total_bets"),
        F.count_distinct("player_id").alias("active_players"),
    )
    net = (F.col("total_deposits") - F.col("total_withdrawals")).cast(TOTAL)
    return row.select(
        "total_deposits", "total_withdrawals", net.alias("net_deposit"),
        safe_ratio(net, F.col("total_deposits")).alias("house_margin"),
        "total_bets", "active_players",
    )


def daily_flow(dim_date: DataFrame, fct_tx: DataFrame) -> DataFrame:
    """Deposits against withdrawals for every calendar day, quiet days included."""
    per_day = fct_tx.groupBy(F.col("txn_date").alias("date_day")).agg(
        sum_of("deposit").alias("total_deposits"), sum_of("withdraw").alias("total_withdrawals")
    )
    zero = F.lit(0).cast(TOTAL)
    return (
        dim_date.select("date_day").join(per_day, "date_day", "left")
        .select("date_day", *[F.coalesce(c, zero).alias(c) for c in ("total_deposits", "total_withdrawals")])
        .orderBy("date_day")
    )


def financials_by_country(fct_tx: DataFrame, dim_player: DataFrame) -> DataFrame:
    return (
        _money_per_player(fct_tx)
        .join(dim_player.select("player_id", "acquisition_country"), "player_id")
        .groupBy("acquisition_country")
        .agg(
            F.sum("deposits").alias("total_deposits"),
            F.sum("withdrawals").alias("total_withdrawals"),
            F.sum(F.col("deposits") - F.col("withdrawals")).alias("net_deposit"),
            F.sum("bets").alias("total_bets"),
        )
    )
