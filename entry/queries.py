"""One callable per operator, each over the whole benchmark tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta
from decimal import Decimal
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wagerlens.operators import assertions as a
from wagerlens.operators import discovery as x
from wagerlens.operators import incremental as inc
from wagerlens.operators import quality as q
from wagerlens.params import DEFAULTS
from wagerlens.plans import bronze, gold, kpis, reports, signals, silver
from wagerlens.session import configure
from wagerlens.sources.driver_tables import DriverTables

Query = Callable[[SparkSession, str], DataFrame]

# Thresholds at which the signals of the benchmark tables are neither empty nor universal.
P = DEFAULTS.but(qualified_baseline=Decimal("800"), max_ips=48, structuring_unit=10, dormant_days=28)
STRICTER_BASELINE = Decimal("900")
AS_OF = datetime(2024, 2, 1)
MID_JANUARY = datetime(2024, 1, 15)
_HOUR = timedelta(hours=1)


class Frames:
    """Lazy frames of one data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.raw = DriverTables(configure(spark), folder)

    @cached_property
    def players(self): return self.raw.players()

    @cached_property
    def sessions(self): return self.raw.sessions()

    @cached_property
    def tx(self): return self.raw.transactions()

    @cached_property
    def aff(self): return self.raw.affiliate()

    @cached_property
    def conformed(self): return silver.players_conformed(self.players)

    @cached_property
    def first_deposit(self): return silver.first_deposit(self.wallet)

    @cached_property
    def qualified(self): return silver.qualified_ftd(self.wallet)

    @cached_property
    def wallet(self): return silver.wallet_profile(self.tx, P)

    @cached_property
    def attribution(self): return silver.affiliate_attribution(self.wallet, self.aff)

    @cached_property
    def financials(self): return silver.player_financials(self.wallet)

    @cached_property
    def activity(self): return silver.player_activity(self.sessions)

    @cached_property
    def ledger(self): return silver.player_ledger(self.tx, P)

    @cached_property
    def dim_date(self): return gold.dim_date(self.tx, self.sessions)

    @cached_property
    def dim_player(self): return gold.dim_player(self.conformed, self.wallet, silver.winning_claims(self.aff))

    @cached_property
    def movements(self):
        """The transaction fact for measures that do not look at balances."""
        return self.tx.withColumn("txn_date", F.to_date("txn_ts"))

    @cached_property
    def fct_tx(self): return gold.fct_transactions(self.ledger)

    @cached_property
    def fct_sessions(self): return gold.fct_sessions(self.sessions)

    @cached_property
    def fraud(self):
        return gold.fct_fraud_signals(self.players, silver.player_wallet(self.tx, P), self.activity, self.aff, P)

    @cached_property
    def performance(self): return gold.agg_affiliate_performance(self.aff, self.wallet)


def plain(df: DataFrame) -> DataFrame:
    """Types a SQL oracle returns too: money and ratios as rounded doubles, naive timestamps."""
    out = []
    for f in df.schema.fields:
        col = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DecimalType, T.DoubleType)):
            col = F.round(col.cast("double"), 6)
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType)):
            col = col.cast("bigint")
        elif isinstance(f.dataType, T.TimestampType):
            col = col.cast("timestamp_ntz")
        out.append(col.alias(f.name))
    return df.select(*out)


def _merge_upsert(f: Frames) -> DataFrame:
    cols = ("transaction_id", "player_id", "transaction_type", "amount")
    loaded = f.tx.where("transaction_type != 'bet'").select(*cols)
    restated = f.tx.where("transaction_type != 'deposit'").select(*cols).withColumn(
        "amount", (F.col("amount") + 1000).cast("decimal(18,2)")
    )
    return inc.merge_upsert(loaded, restated, "transaction_id")


def _insert_overwrite(f: Frames) -> DataFrame:
    batch = inc.incremental_window(f.fct_sessions, f.fct_sessions, "session_ts", "session_date", P.lookback_days)
    return inc.overwrite_partitions(f.fct_sessions, batch.withColumn("device", F.upper("device")), "session_date")


def _schema_evolution(f: Frames) -> DataFrame:
    old = f.tx.where("transaction_type = 'deposit'").select("transaction_id", "amount")
    new = f.tx.where("transaction_type != 'deposit'").select("transaction_id", "amount", "transaction_type")
    return inc.union_evolve(old, new)


def _incremental_window(f: Frames) -> DataFrame:
    loaded = f.tx.where("transaction_type = 'deposit'")
    return inc.incremental_window(f.tx, loaded, "txn_ts", "txn_ts", P.lookback_days)


def _freshness(f: Frames) -> DataFrame:
    daily, hourly = (25 * _HOUR, 48 * _HOUR), (1 * _HOUR, 2 * _HOUR)
    return q.freshness(
        {
            "players": (f.players, "created_at", *daily),
            "sessions": (f.sessions, "session_ts", *daily),
            "transactions": (f.tx, "txn_ts", *hourly),
        },
        AS_OF,
    )


def _suite(f: Frames) -> DataFrame:
    return q.run_suite([
        q.Check("transaction_id unique", "error", q.unique(f.tx, ["transaction_id"])),
        q.Check("affiliate pairs unique", "warn", q.unique(f.aff, ["affiliate_id", "player_id"])),
        q.Check("device accepted", "error", q.accepted_values(f.sessions, "device", ["signup", "purchase", "view", "click"])),
        q.Check("transaction refers to a player", "error", q.relationships(f.tx, "player_id", f.players, "player_id")),
        q.Check("ftd <= registrations", "warn", a.ftd_within_registrations(f.aff)),
    ])


def _every_player_has_profile(f: Frames) -> DataFrame:
    incomplete = f.fraud.join(f.activity.select("player_id"), "player_id", "left_semi")
    return a.every_player_has_profile(f.dim_player, incomplete)


def _risk_score_mismatch(f: Frames) -> DataFrame:
    wrong = f.fraud.withColumn("risk_score", F.col("risk_score") + F.col("s_dormant").cast("bigint"))
    return a.risk_score_matches_flags(wrong)


def _running_balance_mismatch(f: Frames) -> DataFrame:
    off = F.when(F.col("transaction_type") == "bet", 1).otherwise(0)
    wrong = f.fct_tx.withColumn("running_balance", (F.col("running_balance") + off).cast("decimal(28,2)"))
    return a.running_balance_reconciles(wrong, P)


def _activity_span(f: Frames):
    return {"players.created_at": (f.players, "created_at"), "sessions.session_ts": (f.sessions, "session_ts"),
            "transactions.txn_ts": (f.tx, "txn_ts")}


# Key -> operator; SURVEY ids in the section comments.
OPERATORS: dict[str, Callable[[Frames], DataFrame]] = {
    # Sources and load strategies (S9, K3-K6)
    "volume_baseline": lambda f: x.volume_baseline(
        {"players": f.players, "sessions": f.sessions, "transactions": f.tx, "affiliate_cpa_ftd": f.aff}),
    "incremental_window": _incremental_window,
    "merge_upsert": _merge_upsert,
    "insert_overwrite": _insert_overwrite,
    "schema_evolution": _schema_evolution,
    # Bronze (B1-B5)
    "stg_players": lambda f: bronze.stg_players(f.raw.raw_players()),
    "stg_sessions": lambda f: bronze.stg_sessions(f.raw.raw_sessions()),
    "stg_transactions": lambda f: bronze.stg_transactions(f.raw.raw_transactions()),
    "stg_affiliate": lambda f: bronze.stg_affiliate_cpa_ftd(f.raw.raw_affiliate()),
    "cast_failures": lambda f: bronze.cast_failures(f.raw.raw_transactions(), bronze.TRANSACTIONS).union(
        bronze.cast_failures(f.raw.raw_affiliate(), bronze.AFFILIATE)),
    # Silver (V1-V7)
    "players_conformed": lambda f: f.conformed,
    "first_deposit": lambda f: f.first_deposit,
    "qualified_ftd": lambda f: f.qualified,
    "affiliate_attribution": lambda f: f.attribution,
    "player_financials": lambda f: f.financials,
    "player_activity": lambda f: f.activity,
    "player_ledger": lambda f: f.ledger,
    # Gold (G1-G7)
    "dim_date": lambda f: f.dim_date,
    "dim_player": lambda f: f.dim_player,
    "dim_affiliate": lambda f: gold.dim_affiliate(f.aff),
    "fct_transactions": lambda f: f.fct_tx,
    "fct_sessions": lambda f: f.fct_sessions,
    "affiliate_performance": lambda f: f.performance,
    "fraud_signals": lambda f: f.fraud,
    # Signals (F1-F12)
    "sig_ghost_ftd": lambda f: signals.ghost_ftd(f.aff, f.wallet),
    "sig_aml_low_play": lambda f: signals.aml_low_play(f.financials, P),
    "sig_ip_velocity": lambda f: signals.ip_velocity(f.activity, P),
    "sig_ledger_anomaly": lambda f: signals.ledger_anomaly(f.tx),
    "sig_net_negative": lambda f: signals.net_negative(f.financials),
    "sig_structuring": lambda f: signals.structuring(f.tx, P),
    "sig_geo_conflict": lambda f: signals.geo_conflict(f.aff),
    "sig_device_takeover": lambda f: signals.device_takeover(f.activity, P),
    "sig_reg_velocity": lambda f: signals.reg_velocity(f.players, P),
    "sig_dormant": lambda f: signals.dormant(f.activity, P),
    "risk_score": lambda f: signals.risk_score(f.fraud.drop("risk_score", "risk_tier")).select(
        "player_id", "risk_score", "risk_tier"),
    # Reports (R1-R5)
    "silver_discovery": lambda f: reports.silver_discovery(f.players, f.sessions, f.tx, f.aff, P),
    "silver_feature_scan": lambda f: reports.silver_feature_scan(f.tx, f.sessions, P),
    "ledger_reconciliation": lambda f: reports.ledger_reconciliation(f.tx, P),
    "fraud_signal_scan": lambda f: reports.fraud_signal_scan(f.fraud, P),
    "dashboard_metrics": lambda f: reports.dashboard_metrics(f.wallet, silver.winning_claims(f.aff), P),
    # Data quality, generic (Q1-Q12)
    "dq_unique": lambda f: q.unique(f.aff, ["affiliate_id", "player_id"]),
    "dq_not_null": lambda f: q.not_null(bronze.stg_transactions(f.raw.raw_transactions()), "amount"),
    "dq_accepted_values": lambda f: q.accepted_values(f.sessions, "device", ["signup", "purchase", "view", "click"]),
    "dq_relationships": lambda f: q.relationships(f.sessions, "player_id", f.attribution, "player_id"),
    "dq_between": lambda f: q.between(f.fraud, "value_at_risk", 0, 1500).select("player_id", "value_at_risk"),
    "dq_freshness": _freshness,
    "dq_volume_anomaly": lambda f: q.volume_anomaly(f.tx, "txn_ts"),
    "dq_suite": _suite,
    "slo_pass_rates": lambda f: q.slo_pass_rates(f.players, f.tx, f.sessions, f.aff, f.movements),
    # Data quality, business rules (A1-A12); inputs are distorted where the data keeps the rule
    "assert_amount_positive": lambda f: a.amount_positive(
        f.tx.withColumn("amount", (F.col("amount") - 100).cast("decimal(18,2)"))),
    "assert_counts_non_negative": lambda f: a.counts_non_negative(f.aff.withColumn("clicks", F.col("clicks") - 25)),
    "assert_no_future_ts": lambda f: a.no_future_timestamps(f.sessions, f.tx, MID_JANUARY),
    "assert_ftd_le_registrations": lambda f: a.ftd_within_registrations(f.aff),
    "assert_registrations_le_clicks": lambda f: a.registrations_within_clicks(f.aff),
    "assert_first_txn_deposit": lambda f: a.first_transaction_is_deposit(f.tx),
    "assert_no_txn_before_created": lambda f: a.no_transaction_before_created(f.tx, f.players, P),
    "assert_qualified_rule": lambda f: a.qualified_has_deposit_and_baseline(f.qualified, STRICTER_BASELINE),
    "assert_cpa_qualified": lambda f: a.cpa_only_for_qualified(
        f.performance.withColumn("qualified_ftds", F.col("qualified_ftds") + 1), f.attribution),
    "assert_fraud_profile_complete": _every_player_has_profile,
    "assert_risk_score": _risk_score_mismatch,
    "assert_running_balance": _running_balance_mismatch,
    # Discovery (X1-X15)
    "column_profile": lambda f: x.column_profile(f.tx),
    "children_per_player": lambda f: x.children_per_parent({
        "sessions": (f.sessions, "player_id"), "transactions": (f.tx, "player_id"), "affiliate": (f.aff, "player_id")}),
    "affiliates_per_player": lambda f: x.max_distinct_per_parent(f.aff, "player_id", "affiliate_id"),
    "coverage_gaps": lambda f: x.coverage_gaps(
        f.players, {"sessions": f.sessions, "transactions": f.tx, "affiliate": f.aff}),
    "time_windows": lambda f: x.time_windows(_activity_span(f)),
    "totals_by_type": lambda f: x.totals_by_type(f.tx),
    "money_pivot": lambda f: x.money_pivot(f.tx),
    "impossible_flows": lambda f: x.impossible_flows(x.money_pivot(f.tx)),
    "players_per_ip": lambda f: x.players_per_ip(f.sessions),
    "multi_account_summary": lambda f: x.multi_account_summary(f.sessions),
    "claimed_vs_real_ftd": lambda f: x.claimed_vs_real_ftd(f.aff, f.tx),
    "attribution_rules": lambda f: x.attribution_rules(f.raw.affiliate_in_order(), f.tx, ["file_no", "line_no"]),
    "join_fanout": lambda f: x.join_fanout(f.tx, f.aff, "player_id", "amount"),
    "logical_duplicates": lambda f: x.logical_duplicates({
        "sessions (player, timestamp)": (f.sessions, ["player_id", "session_ts"]),
        "transactions (player, type, amount, timestamp)":
            (f.tx, ["player_id", "transaction_type", "amount", "txn_ts"]),
        "affiliate (affiliate, player)": (f.aff, ["affiliate_id", "player_id"]),
        "affiliate full row": (f.aff, f.aff.columns)}),
    "affiliate_grain": lambda f: x.conflated_grain(f.aff),
    "ts_granularity": lambda f: x.ts_text_audit({
        "players.created_at": (f.raw.raw_players(), "created_at"),
        "sessions.timestamp": (f.raw.raw_sessions(), "timestamp"),
        "transactions.timestamp": (f.raw.raw_transactions(), "timestamp")}),
    "load_controls": lambda f: x.load_controls({
        "players": (f.players, "player_id", "created_at"), "sessions": (f.sessions, "session_id", "session_ts"),
        "transactions": (f.tx, "transaction_id", "txn_ts"), "affiliate": (f.aff, "affiliate_id", None)}),
    "cardinalities": lambda f: x.cardinalities({
        "players": (f.players, ["player_id"], ["city"]), "sessions": (f.sessions, ["ip"], ["device"]),
        "transactions": (f.tx, [], ["transaction_type"]), "affiliate": (f.aff, ["affiliate_id"], ["country"])}),
    "fact_shape": lambda f: x.fact_shape({
        "transactions": (f.tx, "txn_ts", "player_id"), "sessions": (f.sessions, "session_ts", "player_id")}),
    # KPIs (M1-M11)
    "kpi_fraud": lambda f: kpis.kpi_fraud(f.fraud, params=P),
    "kpi_fraud_sliced": lambda f: kpis.kpi_fraud(f.fraud, F.col("risk_score").between(2, 5), P),
    "kpi_investigation": lambda f: kpis.investigation(f.fraud, f.dim_player),
    "kpi_by_signal": lambda f: kpis.by_signal(f.fraud),
    "kpi_var_by_country": lambda f: kpis.var_by_country(f.fraud, f.dim_player),
    "kpi_acquisition": lambda f: kpis.kpi_acquisition(f.dim_player, f.movements, f.performance),
    "kpi_retention": lambda f: kpis.retention(f.movements),
    "kpi_acquisition_by_country": lambda f: kpis.acquisition_by_country(f.dim_player, f.movements),
    "kpi_affiliate": lambda f: kpis.kpi_affiliate(f.performance),
    "kpi_affiliate_detail": lambda f: kpis.affiliate_detail(f.performance),
    "kpi_financial": lambda f: kpis.kpi_financial(f.movements),
    "kpi_financial_sliced": lambda f: kpis.kpi_financial(
        f.movements, F.col("txn_date").between(datetime(1996, 1, 1).date(), datetime(1997, 12, 31).date())),
    "kpi_daily_flow": lambda f: kpis.daily_flow(f.dim_date, f.movements),
    "kpi_financial_by_country": lambda f: kpis.financials_by_country(f.movements, f.dim_player),
}


def _bound(operator: Callable[[Frames], DataFrame]) -> Query:
    return lambda spark, folder: plain(operator(Frames(spark, folder)))


QUERIES: dict[str, Query] = {name: _bound(op) for name, op in OPERATORS.items()}
