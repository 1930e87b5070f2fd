"""The five analysis reports: labelled rows ordered by ``step``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wagerlens.functions.scalars import is_type, one_row, safe_ratio, signed_amount
from wagerlens.operators.quality import relationships
from wagerlens.operators.skew import lookup_join, running_total
from wagerlens.params import DEFAULTS, Params
from wagerlens.plans import silver
from wagerlens.plans.signals import aml_low_play_rule
from wagerlens.schemas import RATIO, TOTAL


def _text(pattern: str, *cols: str | Column) -> Column:
    return F.format_string(pattern, *[F.col(c) if isinstance(c, str) else c for c in cols])


def _lines(row: DataFrame, lines: list[tuple[Column, ...]], names: list[str]) -> DataFrame:
    """Turn one row of figures into labelled report lines."""
    structs = [F.struct(*[c.alias(n) for c, n in zip(line, names)]) for line in lines]
    return row.select(F.inline(F.array(*structs))).orderBy("step")


def _findings(row: DataFrame, lines: list[tuple[str, Column, Column]]) -> DataFrame:
    numbered = [
        (F.lit(i), F.lit(label), n.cast("bigint"), note) for i, (label, n, note) in enumerate(lines, start=1)
    ]
    return _lines(row, numbered, ["step", "finding", "n", "note"])


def silver_discovery(
    stg_players: DataFrame, stg_sessions: DataFrame, stg_tx: DataFrame, stg_aff: DataFrame, params: Params = DEFAULTS
) -> DataFrame:
    """What Silver has to repair, counted.

    Players are unique on player_id (checked in Bronze). Every rule that compares a movement with
    a fact about its player shares one join, and every rule about a player's affiliate rows one
    aggregation.
    """
    emails = stg_players.agg(
        F.count_if(F.col("email").rlike("[A-Z]")).alias("upper"),
        F.count_distinct("email").alias("raw_emails"),
        F.count_distinct(F.lower("email")).alias("lower_emails"),
    )
    known = stg_players.select("player_id", "created_at", F.lit(True).alias("known"))
    is_orphan = F.col("known").isNull() & F.col("player_id").isNotNull()
    nameless = stg_sessions.where("player_id is null").select(F.lit(1).cast("long").alias("n_records"))
    # A row without an id has no player either.
    sessions = relationships(stg_sessions, "player_id", stg_players, "player_id").select("n_records").union(nameless).agg(
        F.coalesce(F.sum("n_records"), F.lit(0)).alias("o_sessions")
    )
    wallet = stg_tx.groupBy("player_id").agg(
        F.min(F.when(is_type("deposit"), F.col("txn_ts"))).alias("first_deposit_ts"),
        F.count_if(is_type("deposit")).alias("n_deposits"),
        F.sum(F.when(is_type("bet"), F.col("amount"))).alias("total_bet"),
    )
    bet = F.coalesce(F.col("total_bet"), F.lit(0).cast(TOTAL))
    depositors = wallet.where("n_deposits > 0").agg(
        F.count("*").alias("deposited"),
        F.count_if(F.col("total_bet").isNotNull()).alias("also_bet"),
        F.count_if(bet >= F.lit(params.qualified_baseline)).alias("qualified"),
    )
    facts = wallet.select("player_id", "first_deposit_ts").join(known, "player_id", "left")
    movements = lookup_join(
        stg_tx.select("transaction_id", "player_id", "transaction_type", "txn_ts"), facts,
        "player_id", ["transaction_id"], params.chunk_rows,
    ).agg(
        F.count_if(F.col("known").isNull()).alias("o_tx"),
        F.count_if(F.col("txn_ts") < F.col("created_at").cast("timestamp")).alias("too_early"),
        F.count_if(is_type("withdraw") & (F.col("txn_ts") < F.col("first_deposit_ts"))).alias("unfunded"),
    )
    affiliates = (
        stg_aff.groupBy("player_id")
        .agg(
            F.count_distinct("country").alias("n_countries"),
            F.count_if(F.col("ftd") > F.col("registrations")).alias("ftd_gt_reg"),
            F.count_if(F.col("registrations") > F.col("clicks")).alias("reg_gt_clicks"),
        )
        .join(known, "player_id", "left")
        .agg(
            F.count_if(is_orphan).alias("o_aff"),
            F.count_if(F.col("n_countries") > 1).alias("multi_country"),
            F.coalesce(F.sum("ftd_gt_reg"), F.lit(0)).alias("ftd_gt_reg"),
            F.coalesce(F.sum("reg_gt_clicks"), F.lit(0)).alias("reg_gt_clicks"),
        )
    )
    pairs = stg_aff.groupBy("affiliate_id", "player_id").agg(F.count("*").alias("n")).agg(
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("excess")
    )
    row = one_row(emails, sessions, depositors, movements, affiliates, pairs)
    base = f"{params.qualified_baseline:f}"
    # Report labels.
    return _findings(row, [
        ("email uppercase -> normalize (not dedup)", F.col("upper"),
         _text("distinct raw=%d = lowercased=%d, so no real duplicate", "raw_emails", "lower_emails")),
        ("orphan child player_ids (referential integrity)", F.col("o_sessions") + F.col("o_tx") + F.col("o_aff"),
         _text("sessions=%d, transactions=%d, affiliate=%d", "o_sessions", "o_tx", "o_aff")),
        ("real FTD: players with an actual deposit", F.col("deposited"), F.lit("earliest deposit per player")),
        (f"qualified FTD: deposited AND bets >= baseline({base})", F.col("qualified"),
         _text("of %d that deposited, %d also placed bets", "deposited", "also_bet")),
        ("transactions before created_at (impossible)", F.col("too_early"), F.lit("checked on every load")),
        ("withdrawals before first deposit (impossible)", F.col("unfunded"), F.lit("checked on every load")),
        ("players tagged with >1 country (multi-tagging)", F.col("multi_country"), F.lit("DQ / fraud smell")),
        ("affiliate ftd > registrations (impossible funnel)", F.col("ftd_gt_reg"), F.lit("checked on every load")),
        ("affiliate registrations > clicks (impossible funnel)", F.col("reg_gt_clicks"), F.lit("checked on every load")),
        ("duplicate (affiliate, player) rows (conflated grain)", F.col("excess"), F.lit("resolved by attribution")),
    ])


def silver_feature_scan(stg_tx: DataFrame, stg_sessions: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """How often each candidate fraud feature fires."""
    money = silver.wallet_profile(stg_tx, params).agg(
        F.count_if(F.col("total_withdrawals") > F.col("total_deposits")).alias("negative"),
        F.count_if(aml_low_play_rule(params)).alias("low_play"),
        F.count_if((F.col("total_deposits") > 0) & (F.col("n_bets") == 0)).alias("no_bets"),
    )
    activity = silver.player_activity(stg_sessions).agg(
        F.count_if(F.col("distinct_ips") > params.max_ips).alias("fast_ip"),
        F.max("distinct_ips").alias("max_ips"),
        F.count_if(F.col("active_span_days") > params.dormant_days).alias("long_span"),
    )
    shared = stg_sessions.groupBy("ip").agg(F.count_distinct("player_id").alias("n")).agg(
        F.count_if(F.col("n") > 1).alias("shared_ips")
    )
    # Report labels.
    return _findings(one_row(money, activity, shared), [
        ("net-negative players (withdrew > deposited)", F.col("negative"), F.lit("the house paid out more than it took")),
        (f"AML low-play: bet_ratio < {params.low_play_ratio:f} AND withdrew", F.col("low_play"),
         F.lit("deposit, barely bet, cash out")),
        ("deposited but never placed a bet", F.col("no_bets"), F.lit("money in, no play")),
        (f"players with > {params.max_ips} distinct IPs (IP velocity)", F.col("fast_ip"),
         _text("max distinct IPs for one player = %d", "max_ips")),
        ("IPs shared by > 1 player (multi-accounting)", F.col("shared_ips"), F.lit("one address, several accounts")),
        (f"players with session span > {params.dormant_days} days (dormancy base)", F.col("long_span"),
         F.lit("distance between first and last session")),
    ])


def ledger_reconciliation(stg_tx: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """Wallets that cannot be explained by their own history."""
    balances = running_total(
        stg_tx, "player_id", ["txn_ts", "transaction_id"], signed_amount(), "balance", params.chunk_rows
    )
    row = (
        balances.groupBy("player_id")
        .agg(
            F.min("balance").cast(TOTAL).alias("low"),
            F.min("txn_ts").alias("first_ts"),
            F.min(F.when(is_type("deposit"), F.col("txn_ts"))).alias("first_deposit_ts"),
        )
        .agg(
            F.count_if(F.col("low") < 0).alias("negative"),
            F.min("low").alias("worst"),
            F.count_if(F.col("first_deposit_ts").isNull() | (F.col("first_ts") < F.col("first_deposit_ts"))).alias("unfunded"),
            F.count_if(F.col("first_deposit_ts").isNull()).alias("never"),
        )
    )
    worst = F.coalesce(F.concat(F.lit("worst reconstructed balance = "), F.col("worst").cast("string")), F.lit(""))
    # Report labels.
    return _findings(row, [
        ("players whose running balance goes NEGATIVE (conservative, no win data)", F.col("negative"), worst),
        ("UNAMBIGUOUS: money-out (bet/withdraw) BEFORE the first deposit", F.col("unfunded"),
         F.lit("impossible whatever the bets won")),
        ("players who never deposited at all but still transacted", F.col("never"), F.lit("no funding at any time")),
    ])


def _scan_lines(p: Params) -> list[tuple[str, Column]]:
    # Report labels.
    return [
        ("CORE  affiliate ghost-FTD (claimed, never qualified)", F.col("s_ghost_ftd")),
        (f"CORE  AML low-play (bet_ratio < {p.low_play_ratio:f} AND withdrew)", F.col("s_aml_low_play")),
        (f"CORE  IP velocity (> {p.max_ips} distinct IPs)", F.col("s_ip_velocity")),
        ("CORE  ledger anomaly (money-out before funding)", F.col("s_ledger_anomaly")),
        ("CORE  net-negative (withdrew > deposited)", F.col("s_net_negative")),
        (f"CORE  MULTI-SIGNAL (risk_score >= {p.high_risk_score}, high confidence)",
         F.col("risk_score") >= p.high_risk_score),
        (f"SEC   structuring (>= {p.structuring_min} round deposits)", F.col("s_structuring")),
        ("SEC   geo conflict (> 1 acquisition country)", F.col("s_geo_conflict")),
        (f"SEC   device takeover (>= {p.device_min} distinct devices)", F.col("s_device_takeover")),
        ("SEC   registration velocity (burst day, top decile)", F.col("s_reg_velocity")),
        (f"SEC   dormant reactivation (active span > {p.dormant_days}d)", F.col("s_dormant")),
    ]


def fraud_signal_scan(fraud: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """Players flagged and money at risk per signal: one aggregation, then one line per signal."""
    lines = _scan_lines(params)
    sums: list[Column] = []
    for i, (_, flag) in enumerate(lines):
        sums.append(F.count_if(flag).alias(f"n{i}"))
        sums.append(F.coalesce(F.sum(F.when(flag, F.col("value_at_risk"))), F.lit(0)).cast(TOTAL).alias(f"v{i}"))
    return _lines(
        fraud.agg(*sums),
        [(F.lit(i + 1), F.lit(label), F.col(f"n{i}"), F.col(f"v{i}")) for i, (label, _) in enumerate(lines)],
        ["step", "signal", "players_flagged", "value_at_risk"],
    )


def dashboard_metrics(wallet: DataFrame, claims: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """Headline figure of each dashboard panel; every player carries its own claim, which counts if it qualified."""
    credited = F.col("is_qualified") & F.col("affiliate_id").isNotNull()
    row = wallet.join(claims.select("player_id", "affiliate_id", "cpa_value"), "player_id", "left").agg(
        F.sum(F.when(credited, F.col("cpa_value"))).alias("cpa"),
        F.sum(F.when(credited, F.col("net_deposit"))).alias("revenue"),
        F.sum("total_deposits").alias("deposits"),
        F.sum("total_withdrawals").alias("withdrawals"),
        F.sum("net_deposit").alias("net"),
        F.count_if(aml_low_play_rule(params)).alias("low_play"),
    )
    return dashboard_lines(row)


def dashboard_lines(row: DataFrame) -> DataFrame:
    roi = F.round(safe_ratio(F.col("revenue").cast(TOTAL), F.col("cpa").cast(TOTAL)), 2)
    # Report labels.
    labels: list[tuple[str, Column]] = [
        ("Affiliate Metrics: CPA owed (R$)", F.col("cpa")),
        ("Affiliate Metrics: real revenue of attributed players (R$)", F.col("revenue")),
        ("Affiliate Metrics: ROI (revenue / CPA)", roi),
        ("Financial Signals: total deposits (R$)", F.col("deposits")),
        ("Financial Signals: total withdrawals (R$)", F.col("withdrawals")),
        ("Financial Signals: house net deposit (R$)", F.col("net")),
        ("Financial Signals: low-play + withdrew players", F.col("low_play")),
    ]
    return _lines(
        row,
        [(F.lit(i), F.lit(label), value.cast(RATIO)) for i, (label, value) in enumerate(labels, start=1)],
        ["step", "kpi", "value"],
    )
