"""The daily run: land, check freshness, Bronze, Silver, Gold, KPIs, with checks after each layer.

Each layer is written before the next reads it, so every Silver figure is computed once, and a
lost executor or a failed run restarts from files rather than from a long lineage.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wagerlens.operators import assertions as rules
from wagerlens.operators import quality as q
from wagerlens.functions.scalars import safe_timestamp
from wagerlens.operators.incremental import incremental_window
from wagerlens.params import DEFAULTS, Params
from wagerlens.plans import bronze, gold, kpis, silver
from wagerlens.schemas import CONTRACTS, COUNTRIES, DEVICES, RAW, RISK_TIERS, TRANSACTION_TYPES
from wagerlens.session import configure
from wagerlens.sinks import facts, tables
from wagerlens.sources import landing, registry
from wagerlens.sources.quarantine import source_schema

_HOUR = timedelta(hours=1)
# Age limits (warn, error) of the sources.
FRESHNESS = {
    "players": (25 * _HOUR, 48 * _HOUR),
    "sessions": (1 * _HOUR, 2 * _HOUR),
    "transactions": (1 * _HOUR, 2 * _HOUR),
    "affiliate_cpa_ftd": (25 * _HOUR, 48 * _HOUR),
}
EVENT_LAG = (25 * _HOUR, 48 * _HOUR)
FACT_DAYS = {"fct_transactions": "txn_date", "fct_sessions": "session_date"}
_KEYS = {"players": "player_id", "sessions": "session_id", "transactions": "transaction_id"}


@dataclass
class Run:
    """One run over an output folder."""

    spark: SparkSession
    out_dir: str
    params: Params
    as_of: datetime
    run_id: str

    def path(self, layer: str, table: str) -> str:
        return f"{self.out_dir}/{layer}/{table}"

    def table(self, layer: str, table: str) -> DataFrame:
        if layer == "raw":
            return landing.accepted(self.spark, self.path(layer, table))
        if table in FACT_DAYS:
            return facts.read_fact(self.spark, self.path(layer, table), FACT_DAYS[table], CONTRACTS[table])
        return tables.read_full(self.spark, self.path(layer, table))

    def save(self, layer: str, table: str, df: DataFrame) -> DataFrame:
        tables.write_full(df, self.path(layer, table))
        return self.table(layer, table)

    def check(self, checks: list[q.Check | q.RowCheck]) -> None:
        """Run the checks, log them, then fail if an error-level one found rows."""
        self.report(q.run_suite(checks))

    def report(self, results: DataFrame) -> None:
        log = f"{self.out_dir}/quality_log"
        q.log_results(results, log, self.run_id, self.as_of)
        q.raise_on_error(self.spark.read.parquet(log).where(F.col("run_id") == self.run_id))


AnyCheck = q.Check | q.RowCheck


def _keyed(prefix: str, df: DataFrame, key: str) -> list[AnyCheck]:
    return [q.Check(f"{prefix}.{key} unique", "error", q.unique(df, [key])), *_filled(prefix, df, key)]


def _filled(prefix: str, df: DataFrame, *cols: str) -> list[AnyCheck]:
    return [q.RowCheck(f"{prefix}.{c} not null", "error", df, F.col(c).isNull()) for c in cols]


def _listed(prefix: str, df: DataFrame, col: str, values: tuple[str, ...]) -> AnyCheck:
    return q.RowCheck(f"{prefix}.{col} accepted", "error", df, ~F.col(col).isin(*values))


def _rule(name: str, severity: str, df: DataFrame, fails: str) -> AnyCheck:
    return q.RowCheck(name, severity, df, F.expr(fails))


def _refers(name: str, child: DataFrame, fk: str, parent: DataFrame, pk: str) -> AnyCheck:
    return q.Check(name, "error", q.relationships(child, fk, parent, pk))


def _statuses(found: DataFrame, what: str, worst: str) -> DataFrame:
    """Freshness as check results; a status above `worst` counts as `worst`."""
    level = F.when(F.col("status") == "error", worst).otherwise(F.col("status"))
    return found.select(
        F.concat(F.lit("raw."), "source", F.lit(f" {what}")).alias("check_name"), F.lit(worst).alias("severity"),
        (level != "pass").cast("bigint").alias("failures"), level.alias("status"),
    )


def check_raw(run: Run, landed: dict[str, landing.Landed]) -> None:
    """What arrived, against what should have: delivery times, volumes against earlier runs, fields against the registry, keys.

    Freshness is that of the delivered files, whenever they were loaded; how old the newest event is only warns.
    Rejected rows and fields that nobody knows warn or fail, and are kept (`landing.rejected`, `landing.widened`).
    """
    raw = {name: run.table("raw", name) for name in RAW}
    delivered = q.freshness({n: (raw[n], "_delivered_at", *FRESHNESS[n]) for n in raw}, run.as_of)
    events = q.freshness(
        {n: (raw[n].select(safe_timestamp(F.col("timestamp")).alias("ts")), "ts", *EVENT_LAG) for n in ("sessions", "transactions")}, run.as_of
    )
    checks: list[AnyCheck] = [c for name, key in _KEYS.items() for c in _keyed(f"raw.{name}", raw[name], key)]
    checks += _filled("raw.affiliate_cpa_ftd", raw["affiliate_cpa_ftd"], "affiliate_id")
    history = run.path("history", "volumes")
    registry.record_volumes(run.spark, history, run.run_id, run.as_of, landed)
    strange = q.delivery_anomaly(registry.volumes(run.spark, history)).where(F.col("run_id") == run.run_id)
    for name in raw:
        checks.append(q.Check(f"raw.{name} volume", "warn", strange.where(F.col("source") == name)))
        checks.append(q.Check(f"raw.{name} rejected rows", "warn", landing.rejected(run.spark, run.path("raw", name))))
        seen = source_schema(landing.whole(run.spark, run.path("raw", name)))
        changes = registry.register(run.spark, run.path("history", "schemas"), name, seen, RAW[name], run.run_id, run.as_of)
        checks.append(q.Check(f"raw.{name} schema unchanged", "error", changes))
    results = [_statuses(delivered, "fresh", "error"), _statuses(events, "newest event", "warn"), q.run_suite(checks)]
    run.report(results[0].unionByName(results[1]).unionByName(results[2]))


def build_bronze(run: Run) -> dict[str, DataFrame]:
    models: dict[str, Callable[[DataFrame], DataFrame]] = {
        "players": bronze.stg_players,
        "sessions": bronze.stg_sessions,
        "transactions": bronze.stg_transactions,
        "affiliate_cpa_ftd": bronze.stg_affiliate_cpa_ftd,
    }
    stg = {name: run.save("bronze", name, model(run.table("raw", name))) for name, model in models.items()}
    players, sessions, tx, aff = (stg[n] for n in models)
    run.check([
        *_keyed("stg_players", players, "player_id"), *_filled("stg_players", players, "email", "created_at"),
        *_keyed("stg_sessions", sessions, "session_id"),
        *_filled("stg_sessions", sessions, "player_id", "device", "session_ts"),
        _listed("stg_sessions", sessions, "device", DEVICES),
        *_keyed("stg_transactions", tx, "transaction_id"),
        *_filled("stg_transactions", tx, "player_id", "transaction_type", "amount", "txn_ts"),
        _listed("stg_transactions", tx, "transaction_type", TRANSACTION_TYPES),
        *_filled("stg_affiliate", aff, "affiliate_id", "player_id", "country", "clicks", "registrations", "ftd", "cpa_value"),
        _listed("stg_affiliate", aff, "country", COUNTRIES),
        _rule("amount positive", "error", tx, rules.AMOUNT_NOT_POSITIVE),
        _rule("affiliate counts not negative", "error", aff, rules.NEGATIVE_COUNTS),
        *[q.RowCheck(f"{name} not in the future", "error", df, F.col(ts) > F.lit(run.as_of).cast("timestamp"))
          for name, df, ts in (("stg_sessions", sessions, "session_ts"), ("stg_transactions", tx, "txn_ts"))],
        _rule("ftd <= registrations", "warn", aff, rules.FTD_ABOVE_REGISTRATIONS),
        _rule("registrations <= clicks", "warn", aff, rules.REGISTRATIONS_ABOVE_CLICKS),
    ])
    return stg


def build_silver(run: Run, stg: dict[str, DataFrame]) -> dict[str, DataFrame]:
    players, sessions, tx, aff = (stg[n] for n in ("players", "sessions", "transactions", "affiliate_cpa_ftd"))
    s: dict[str, DataFrame] = {}
    s["players_conformed"] = run.save("silver", "players_conformed", silver.players_conformed(players))
    s["wallet"] = run.save("silver", "wallet", silver.player_wallet(tx, run.params))
    s["first_deposit"] = run.save("silver", "first_deposit", silver.first_deposit(s["wallet"]))
    s["qualified_ftd"] = run.save("silver", "qualified_ftd", silver.qualified_ftd(s["wallet"]))
    s["attribution"] = run.save("silver", "attribution", silver.affiliate_attribution(s["wallet"], aff))
    s["financials"] = run.save("silver", "financials", silver.player_financials(s["wallet"]))
    s["activity"] = run.save("silver", "activity", silver.player_activity(sessions))
    s["ledger"] = run.save("silver", "ledger", silver.player_ledger(tx, run.params))
    checks: list[AnyCheck] = [c for name in s if name != "ledger" for c in _keyed(name, s[name], "player_id")]
    checks += _keyed("ledger", s["ledger"], "transaction_id")
    for name, col in (
        ("players_conformed", "email"), ("first_deposit", "first_deposit_ts"), ("qualified_ftd", "is_qualified"),
        ("attribution", "affiliate_id"), ("ledger", "player_id"),
    ):
        checks += _filled(name, s[name], col)
    checks += [
        _refers(f"{name} refers to a player", s[name], "player_id", s["players_conformed"], "player_id")
        for name in ("financials", "activity", "ledger")
    ]
    checks += [
        _refers("qualified is a depositor", s["qualified_ftd"], "player_id", s["first_deposit"], "player_id"),
        _refers("attributed is a depositor", s["attribution"], "player_id", s["qualified_ftd"], "player_id"),
        q.Check("qualified has deposit and baseline", "error",
                rules.qualified_has_deposit_and_baseline(s["qualified_ftd"], run.params.qualified_baseline)),
        q.Check("first transaction is a deposit", "warn", rules.first_transaction_is_deposit(s["ledger"])),
        q.Check("no transaction before created_at", "warn",
                rules.no_transaction_before_created(tx, s["players_conformed"], run.params)),
    ]
    run.check(checks)
    return s


def load_transactions(run: Run, ledger: DataFrame, full_refresh: bool) -> None:
    path, day, contract = run.path("gold", "fct_transactions"), FACT_DAYS["fct_transactions"], CONTRACTS["fct_transactions"]
    fact = q.enforce_contract(gold.fct_transactions(ledger), contract)
    if full_refresh or not facts.exists(run.spark, path):
        facts.write_fact(fact, path, day, "player_id", "transaction_id")
        return
    newest = facts.newest_day(run.spark, path, day, contract)
    batch = incremental_window(fact, newest, "txn_ts", "txn_ts", run.params.lookback_days)
    facts.merge_into_path(batch, path, "transaction_id", day, "player_id", contract)


def load_sessions(run: Run, stg_sessions: DataFrame, full_refresh: bool) -> None:
    path, day, contract = run.path("gold", "fct_sessions"), FACT_DAYS["fct_sessions"], CONTRACTS["fct_sessions"]
    fact = q.enforce_contract(gold.fct_sessions(stg_sessions), contract)
    if full_refresh or not facts.exists(run.spark, path):
        facts.write_fact(fact, path, day, "player_id", "session_id")
        return
    newest = facts.newest_day(run.spark, path, day, contract)
    batch = incremental_window(fact, newest, "session_ts", day, run.params.lookback_days)
    facts.overwrite_days(batch, path, day, "player_id", "session_id")


def build_gold(run: Run, stg: dict[str, DataFrame], s: dict[str, DataFrame], full_refresh: bool) -> dict[str, DataFrame]:
    players, sessions, tx, aff = (stg[n] for n in ("players", "sessions", "transactions", "affiliate_cpa_ftd"))
    models = {
        "dim_date": gold.dim_date(tx, sessions),
        "dim_player": gold.dim_player(s["players_conformed"], s["wallet"], s["attribution"]),
        "dim_affiliate": gold.dim_affiliate(aff),
        "fct_fraud_signals": gold.fct_fraud_signals(players, s["wallet"], s["activity"], aff, run.params),
        "agg_affiliate_performance": gold.agg_affiliate_performance(aff, s["wallet"]),
    }
    g = {name: run.save("gold", name, q.enforce_contract(df, CONTRACTS[name])) for name, df in models.items()}
    load_transactions(run, s["ledger"], full_refresh)
    load_sessions(run, sessions, full_refresh)
    g["fct_transactions"] = run.table("gold", "fct_transactions")
    g["fct_sessions"] = run.table("gold", "fct_sessions")
    fraud, dim_player, perf, fct = (g[n] for n in ("fct_fraud_signals", "dim_player", "agg_affiliate_performance", "fct_transactions"))
    run.check([
        *_keyed("dim_date", g["dim_date"], "date_day"), *_filled("dim_date", g["dim_date"], "year_month"),
        *_keyed("dim_player", dim_player, "player_id"),
        *_filled("dim_player", dim_player, "email", "is_qualified_ftd", "is_one_and_done"),
        *_keyed("dim_affiliate", g["dim_affiliate"], "affiliate_id"),
        _listed("dim_affiliate", g["dim_affiliate"], "primary_country", COUNTRIES),
        *_keyed("fct_transactions", fct, "transaction_id"),
        *_filled("fct_transactions", fct, "player_id", "transaction_type", "amount", "running_balance"),
        _listed("fct_transactions", fct, "transaction_type", TRANSACTION_TYPES),
        *_keyed("fct_sessions", g["fct_sessions"], "session_id"),
        *_filled("fct_sessions", g["fct_sessions"], "player_id", "device"),
        _listed("fct_sessions", g["fct_sessions"], "device", DEVICES),
        *_keyed("fct_fraud_signals", fraud, "player_id"),
        *_filled("fct_fraud_signals", fraud, "value_at_risk", "risk_score", "risk_tier"),
        _listed("fct_fraud_signals", fraud, "risk_tier", RISK_TIERS),
        _rule("risk_score in 0..5", "error", fraud, "risk_score not between 0 and 5"),
        _rule("value_at_risk >= 0", "error", fraud, "value_at_risk < 0"),
        *_keyed("agg_affiliate_performance", perf, "affiliate_id"),
        *_filled("agg_affiliate_performance", perf, "qualified_ftds", "ghost_ftds"),
        _refers("player's affiliate exists", dim_player, "acquisition_affiliate_id", g["dim_affiliate"], "affiliate_id"),
        _refers("transaction's player exists", fct, "player_id", dim_player, "player_id"),
        _refers("session's player exists", g["fct_sessions"], "player_id", dim_player, "player_id"),
        _refers("profile's player exists", fraud, "player_id", dim_player, "player_id"),
        _refers("performance's affiliate exists", perf, "affiliate_id", g["dim_affiliate"], "affiliate_id"),
        q.Check("CPA only for qualified", "error", rules.cpa_only_for_qualified(perf, s["attribution"])),
        q.Check("every player has a profile", "error", rules.every_player_has_profile(dim_player, fraud)),
        q.Check("risk score is the sum of core flags", "error", rules.risk_score_matches_flags(fraud)),
        q.Check("running balance reconciles", "error", rules.running_balance_reconciles(fct, run.params)),
    ])
    return g


def build_kpis(run: Run, g: dict[str, DataFrame]) -> None:
    fraud, dim_player, perf, fct = (g[n] for n in ("fct_fraud_signals", "dim_player", "agg_affiliate_performance", "fct_transactions"))
    frames = {
        "fraud": kpis.kpi_fraud(fraud, params=run.params),
        "investigation": kpis.investigation(fraud, dim_player),
        "by_signal": kpis.by_signal(fraud),
        "var_by_country": kpis.var_by_country(fraud, dim_player),
        "acquisition": kpis.kpi_acquisition(dim_player, fct, perf),
        "retention": kpis.retention(fct),
        "acquisition_by_country": kpis.acquisition_by_country(dim_player, fct),
        "affiliate": kpis.kpi_affiliate(perf),
        "financial": kpis.kpi_financial(fct),
        "daily_flow": kpis.daily_flow(g["dim_date"], fct),
        "financials_by_country": kpis.financials_by_country(fct, dim_player),
    }
    for name, df in frames.items():
        tables.write_full(df, run.path("kpi", name))


def run_pipeline(
    spark: SparkSession, src_dir: str, out_dir: str, as_of: datetime, params: Params = DEFAULTS,
    full_refresh: bool = False, sources: Sequence[landing.Source] = landing.SOURCES,
) -> Run:
    """One complete run. Every attempt has a run id of its own, so one that failed may be repeated. A failed error-level check raises and leaves later layers as they were.

    The transaction fact re-reads ``lookback_days`` before its newest row. A movement arriving
    later than that stays out, while balances after it include it, until ``full_refresh=True``.
    """
    run = Run(configure(spark), out_dir, params, as_of, f"{as_of:%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}")
    check_raw(run, landing.land_all(spark, src_dir, out_dir, as_of, sources=sources))
    stg = build_bronze(run)
    s = build_silver(run, stg)
    g = build_gold(run, stg, s, full_refresh)
    build_kpis(run, g)
    return run
