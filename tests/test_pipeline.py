"""The whole run on a small set of source files, twice, then with late and changed data."""

import csv
import json
import random
from datetime import datetime, timedelta
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

from entry import queries
from entry.oracles import ORACLES
from tests.conftest import rows
from tests.test_oracles import _table
from wagerlens.operators.quality import ContractError, QualityError, enforce_contract
from wagerlens.plans.pipeline import Run, load_transactions, run_pipeline
from wagerlens.schemas import CONTRACTS, COUNTRIES, DEVICES, RAW, TRANSACTION_TYPES
from wagerlens.sources.driver_tables import DriverTables

START = datetime(2024, 1, 1)
AS_OF = datetime(2024, 3, 1)


def _source(seed: int = 7):
    rnd = random.Random(seed)
    when = lambda: START + timedelta(days=rnd.randrange(30), seconds=rnd.randrange(86400))
    players = [
        {"player_id": f"pl_{i}", "email": f"{'USER' if i % 5 == 0 else 'user'}{i}@mail.com", "city": f"c{i % 4}",
         "created_at": str((START + timedelta(days=i % 6)).date())}
        for i in range(30)
    ]
    sessions = [
        {"session_id": f"ss_{i}", "player_id": f"pl_{rnd.randrange(30)}", "ip": f"10.0.0.{rnd.randrange(60)}",
         "device": rnd.choice(DEVICES), "timestamp": when().isoformat() + ".000123"}
        for i in range(120)
    ]
    tx = [
        {"transaction_id": f"tx_{i}", "player_id": f"pl_{rnd.randrange(28)}", "type": rnd.choice(TRANSACTION_TYPES),
         "amount": f"{rnd.randrange(1000, 30000) / 100:.2f}", "timestamp": str(when())}
        for i in range(200)
    ]
    aff = [
        {"affiliate_id": f"aff_{rnd.randrange(6)}", "player_id": f"pl_{rnd.randrange(30)}", "country": rnd.choice(COUNTRIES),
         "clicks": rnd.randrange(1, 200), "registrations": rnd.randrange(30), "ftd": rnd.randrange(3), "cpa_value": rnd.choice((30, 50, 100))}
        for _ in range(90)
    ]
    return {"players": players, "sessions": sessions, "transactions": tx, "affiliate_cpa_ftd": aff}


def _deliver(folder, data):
    folder.mkdir(exist_ok=True)
    for name in ("players", "sessions"):
        (folder / f"{name}.json").write_text(json.dumps(data[name], indent=2))
    for name in ("transactions", "affiliate_cpa_ftd"):
        with open(folder / f"{name}.csv", "w", newline="") as f:
            writer = csv.DictWriter(f, RAW[name].names)
            writer.writeheader()
            writer.writerows(data[name])
    return str(folder)


@pytest.fixture(scope="module")
def delivered(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("run")
    data = _source()
    run = run_pipeline(spark, _deliver(root / "src", data), str(root / "out"), AS_OF)
    return root, data, run


def _gold(run):
    return {name: rows(run.table("gold", name), *CONTRACTS[name].names) for name in CONTRACTS}


def test_gold_keeps_its_contracts_and_its_rows(delivered):
    _, data, run = delivered
    for name, contract in CONTRACTS.items():
        enforce_contract(run.table("gold", name).select(*contract.names), contract)
    assert run.table("gold", "fct_transactions").count() == len(data["transactions"])
    assert run.table("gold", "fct_sessions").count() == len(data["sessions"])
    assert run.table("gold", "fct_fraud_signals").count() == len(data["players"])
    emails = [r.email for r in run.table("gold", "dim_player").collect()]
    assert all(e == e.lower() for e in emails)


def test_results_are_logged(spark, delivered):
    _, _, run = delivered
    log = spark.read.parquet(f"{run.out_dir}/quality_log")
    assert log.where("severity = 'error' and failures > 0").count() == 0
    assert log.where("check_name = 'no transaction before created_at'").first().status == "warn"
    assert log.where("check_name = 'raw.sessions fresh'").first().status == "pass"


def test_kpis_agree_with_the_facts(delivered):
    _, data, run = delivered
    card = run.table("kpi", "financial").first()
    deposits = sum(float(t["amount"]) for t in data["transactions"] if t["type"] == "deposit")
    assert float(card.total_deposits) == pytest.approx(deposits)
    assert run.table("kpi", "fraud").first().players_scanned == len(data["players"])


def test_running_again_then_late_data(spark, delivered):
    """One sequence, since each step builds on the tables before it."""
    root, data, run = delivered
    first = _gold(run)
    newest = max(t["timestamp"] for t in data["transactions"])
    inside = str(datetime.fromisoformat(newest) - timedelta(days=2))
    outside = str(datetime.fromisoformat(newest) - timedelta(days=10))
    # The last two players have no other movement, so no stored balance of theirs can go stale.
    data["transactions"] += [
        {"transaction_id": "tx_in", "player_id": "pl_29", "type": "deposit", "amount": "10.00", "timestamp": inside},
        {"transaction_id": "tx_out", "player_id": "pl_28", "type": "deposit", "amount": "10.00", "timestamp": outside},
    ]
    _deliver(root / "src", data)
    late = run_pipeline(spark, str(root / "src"), run.out_dir, AS_OF + timedelta(minutes=2))
    second = _gold(late)
    added = set(second["fct_transactions"]) - set(first["fct_transactions"])
    assert [r[0] for r in added] == ["tx_in"]  # what was there is neither doubled nor changed
    assert len(second["fct_transactions"]) == len(first["fct_transactions"]) + 1
    assert second["fct_sessions"] == first["fct_sessions"]

    load_transactions(late, late.table("silver", "ledger"), full_refresh=False)
    assert rows(late.table("gold", "fct_transactions"), *CONTRACTS["fct_transactions"].names) == second["fct_transactions"]
    load_transactions(late, late.table("silver", "ledger"), full_refresh=True)
    assert late.table("gold", "fct_transactions").where("transaction_id = 'tx_out'").count() == 1


def test_a_run_on_exported_tables_equals_the_sql(spark, tmp_path, monkeypatch):
    """What the daily run stores, from files on, is what the registered queries are held against."""
    folder = Path("/root/testdata/sf0.001")
    if not folder.exists():
        pytest.skip("benchmark tables are not here")
    source = DriverTables(spark, str(folder))
    text = lambda df, **names: [{names.get(k, k): None if v is None else str(v) for k, v in r.asDict().items()} for r in df.collect()]
    iso = source.sessions().withColumn("session_ts", F.date_format("session_ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
    data = {
        "players": text(source.players()), "sessions": text(iso, session_ts="timestamp"),
        "transactions": text(source.transactions(), transaction_type="type", txn_ts="timestamp"), "affiliate_cpa_ftd": text(source.affiliate()),
    }
    monkeypatch.setattr(Run, "report", lambda self, results: None)  # these tables have other countries and devices
    run = run_pipeline(spark, _deliver(tmp_path / "src", data), str(tmp_path / "out"), AS_OF, queries.P)
    duck = duckdb.connect()
    for path in folder.glob("*.parquet"):
        duck.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    tables = {
        "dim_player": ("gold", "dim_player"), "dim_affiliate": ("gold", "dim_affiliate"), "fraud_signals": ("gold", "fct_fraud_signals"),
        "affiliate_performance": ("gold", "agg_affiliate_performance"), "player_financials": ("silver", "financials"),
        "qualified_ftd": ("silver", "qualified_ftd"), "first_deposit": ("silver", "first_deposit"), "kpi_retention": ("kpi", "retention"),
    }
    for name, place in tables.items():
        stored, want = queries.plain(run.table(*place)), duck.sql(ORACLES[name])
        columns = [c for c in want.columns]
        assert _table(columns, [tuple(r) for r in stored.select(*columns).collect()]) == _table(columns, want.fetchall()), name


def test_an_error_level_check_stops_the_run(spark, tmp_path):
    data = _source(11)
    data["transactions"][0]["amount"] = "n/a"
    with pytest.raises(QualityError, match="stg_transactions.amount not null: 1 failing rows"):
        run_pipeline(spark, _deliver(tmp_path / "src", data), str(tmp_path / "out"), AS_OF)
    assert not (tmp_path / "out" / "gold").exists()


def test_contract_error_is_not_swallowed(frame):
    with pytest.raises(ContractError):
        enforce_contract(frame("player_id string", ("p",)), CONTRACTS["dim_player"])
