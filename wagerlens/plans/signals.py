"""Fraud signals. Each rule is one Column; each function applies one rule to its own input.

The Gold fact evaluates the same Columns on one joined row per player, so a rule exists once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wagerlens.functions.scalars import safe_ratio
from wagerlens.params import DEFAULTS, Params
from wagerlens.plans.silver import affiliate_profile, opening_movement, round_deposit_count
from wagerlens.schemas import CORE_SIGNALS, TOTAL


def _flag(rule: Column) -> Column:
    """A player without the input has no signal, rather than an unknown one."""
    return F.coalesce(rule, F.lit(False))


def ghost_ftd_rule() -> Column:
    return _flag(F.col("has_claim")) & ~_flag(F.col("is_qualified"))


def aml_low_play_rule(p: Params) -> Column:
    barely_bet = safe_ratio(F.col("total_bets"), F.col("total_deposits")) < F.lit(p.low_play_ratio)
    return _flag((F.col("total_deposits") > 0) & barely_bet & (F.col("total_withdrawals") > 0))


def ip_velocity_rule(p: Params) -> Column:
    return _flag(F.col("distinct_ips") > p.max_ips)


def ledger_anomaly_rule() -> Column:
    return _flag(F.col("first_type") != "deposit")


def net_negative_rule() -> Column:
    return _flag(F.col("net_deposit") < 0)


def structuring_rule(p: Params) -> Column:
    return _flag(F.col("n_round") >= p.structuring_min)


def geo_conflict_rule() -> Column:
    return _flag(F.col("n_countries") > 1)


def device_takeover_rule(p: Params) -> Column:
    return _flag(F.col("distinct_devices") >= p.device_min)


def dormant_rule(p: Params) -> Column:
    return _flag(F.col("active_span_days") > p.dormant_days)


def value_at_risk_rule() -> Column:
    return F.coalesce(F.col("total_withdrawals"), F.lit(0)).cast(TOTAL)


def risk_score_rule() -> Column:
    score = F.lit(0).cast("bigint")
    for name in CORE_SIGNALS:
        score = score + F.col(name).cast("bigint")
    return score


def risk_tier_rule() -> Column:
    score = F.col("risk_score")
    return (
        F.when(score >= 4, "Critical").when(score == 3, "High").when(score == 2, "Medium")
        .when(score >= 1, "Low").otherwise("No alert")
    )


def _signal(frame: DataFrame, rule: Column, name: str) -> DataFrame:
    return frame.select("player_id", rule.alias(name))


def ghost_ftd(stg_aff: DataFrame, qualified: DataFrame) -> DataFrame:
    """Players some affiliate claims an FTD for, who never qualified."""
    claimed = affiliate_profile(stg_aff).where(F.col("player_id").isNotNull())
    return _signal(claimed.join(qualified.select("player_id", "is_qualified"), "player_id", "left"),
                   ghost_ftd_rule(), "s_ghost_ftd")


def aml_low_play(financials: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    return _signal(financials, aml_low_play_rule(params), "s_aml_low_play")


def ip_velocity(activity: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    return _signal(activity, ip_velocity_rule(params), "s_ip_velocity")


def ledger_anomaly(ledger: DataFrame) -> DataFrame:
    """Works on the ledger or on plain transactions: only order and type matter."""
    return _signal(opening_movement(ledger), ledger_anomaly_rule(), "s_ledger_anomaly")


def net_negative(financials: DataFrame) -> DataFrame:
    return _signal(financials, net_negative_rule(), "s_net_negative")


def structuring(stg_tx: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    rounds = stg_tx.groupBy("player_id").agg(round_deposit_count(params.structuring_unit).alias("n_round"))
    return _signal(rounds, structuring_rule(params), "s_structuring")


def geo_conflict(stg_aff: DataFrame) -> DataFrame:
    return _signal(affiliate_profile(stg_aff), geo_conflict_rule(), "s_geo_conflict")


def device_takeover(activity: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    return _signal(activity, device_takeover_rule(params), "s_device_takeover")


def registration_days(stg_players: DataFrame, quantile: float = DEFAULTS.registration_quantile) -> DataFrame:
    """(created_at, is_burst): one row per registration day, flagged in the top decile of volumes."""
    daily = stg_players.groupBy("created_at").agg(F.count("*").alias("n"))
    threshold = daily.agg(F.percentile_approx("n", quantile, 10_000)).scalar()
    return daily.select("created_at", (F.col("n") >= threshold).alias("is_burst"))


def with_registration_burst(stg_players: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """(player_id, created_at, is_burst).

    One row per calendar day is broadcast, whatever the number of players, and no player is
    shuffled by day - a launch day with a third of all players stays spread out.
    """
    days = registration_days(stg_players, params.registration_quantile)
    return stg_players.select("player_id", "created_at").join(F.broadcast(days), "created_at", "left")


def reg_velocity(stg_players: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    return _signal(with_registration_burst(stg_players, params), _flag(F.col("is_burst")), "s_reg_velocity")


def dormant(activity: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    return _signal(activity, dormant_rule(params), "s_dormant")


def risk_score(flags: DataFrame) -> DataFrame:
    """Add score and tier to any frame holding the five core flags."""
    return flags.withColumn("risk_score", risk_score_rule()).withColumn("risk_tier", risk_tier_rule())


def score_players(
    players: DataFrame, wallet: DataFrame, activity: DataFrame, affiliates: DataFrame, params: Params = DEFAULTS
) -> DataFrame:
    """The fraud profile: one row per player from one-row-per-player inputs.

    ``players`` carries player_id and is_burst. The other inputs are already grouped by
    player_id, so only ``players`` is moved for the joins.
    """
    joined = (
        players.join(wallet, "player_id", "left")
        .join(activity.select("player_id", "distinct_ips", "distinct_devices", "active_span_days"), "player_id", "left")
        .join(affiliates, "player_id", "left")
    )
    flags = joined.select(
        "player_id",
        ghost_ftd_rule().alias("s_ghost_ftd"),
        aml_low_play_rule(params).alias("s_aml_low_play"),
        ip_velocity_rule(params).alias("s_ip_velocity"),
        ledger_anomaly_rule().alias("s_ledger_anomaly"),
        net_negative_rule().alias("s_net_negative"),
        structuring_rule(params).alias("s_structuring"),
        geo_conflict_rule().alias("s_geo_conflict"),
        device_takeover_rule(params).alias("s_device_takeover"),
        _flag(F.col("is_burst")).alias("s_reg_velocity"),
        dormant_rule(params).alias("s_dormant"),
        value_at_risk_rule().alias("value_at_risk"),
    )
    return risk_score(flags)
