"""Landing that keeps everything: records of split files, rejected rows, widened deliveries; registry and history of the sources."""

import json
import os
import random
import uuid
from datetime import datetime, timedelta, timezone

import pytest

from tests.conftest import rows
from tests.test_pipeline import AS_OF, _deliver, _source
from wagerlens.operators.quality import QualityError, delivery_anomaly
from wagerlens.params import DEFAULTS
from wagerlens.plans.pipeline import Run, check_raw
from wagerlens.schemas import RAW, _text
from wagerlens.session import configure
from wagerlens.sources import landing, registry
from wagerlens.sources.landing import Landed, Source
from wagerlens.sources.quarantine import csv_headers, source_schema, split_json, split_source
from wagerlens.sources.readers import read_json_array
from wagerlens.sources.records import json_line_records, json_records, lines_of

LOADED = datetime(2024, 2, 1, 6)


@pytest.fixture
def small_blocks(spark):
    """Files are cut into many tasks, so records cross blocks."""
    kept = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    for k, v in kept.items():
        spark.conf.set(k, v)


def _write(path, text):
    path.write_bytes(text.encode() if isinstance(text, str) else text)
    return str(path)


def _records(n, seed=1):
    rng = random.Random(seed)
    strings = ["x", "{[", '}]"', "\\", '\\"', "a\\\\", "é\n", ",", ""]
    return [
        {"a": rng.choice([*strings, None, 1, 2.5, True]), "b": {"z": [1, {"y": rng.choice(strings)}], "e": [], "o": {}}, "c": "q" * rng.randint(0, 60), "d": i}
        for i in range(n)
    ]


LAYOUTS = {
    "pretty": lambda r: json.dumps(r, indent=2),
    "wide": lambda r: json.dumps(r, indent=7, ensure_ascii=False),
    "compact": json.dumps,
    "a line each": lambda r: "[\n" + ",\n".join(map(json.dumps, r)) + "\n]\n",
    "crlf": lambda r: json.dumps(r, indent=1).replace("\n", "\r\n"),
    "objects in a row": lambda r: "\n".join(json.dumps(x, indent=1) for x in r),
    "blank lines": lambda r: "\n\n" + json.dumps(r, indent=1).replace("\n", "\n\n") + "\n\n",
}


@pytest.mark.parametrize("layout", sorted(LAYOUTS))
def test_records_of_a_split_file(spark, tmp_path, small_blocks, layout):
    want = _records(150)
    path = _write(tmp_path / "a.json", LAYOUTS[layout](want))
    found = json_records(spark, path)
    if layout != "compact":  # one line is one place
        assert lines_of(spark, path).rdd.getNumPartitions() > 4
    got = found.collect()
    assert not any(r.outside for r in got)
    order = lambda r: json.dumps(r, sort_keys=True)
    assert sorted(map(order, (json.loads(r.record) for r in got))) == sorted(map(order, want))


def test_split_rows_equal_the_one_task_reader(spark, tmp_path, small_blocks):
    path = _write(tmp_path / "a.json", json.dumps(_records(80), indent=2))
    schema = _text("a", "b", "c", "d", "absent")
    split = split_json(json_records(spark, path), schema)
    plain = lambda df: sorted(str((r.a, json.loads(r.b), r.c, r.d, r.absent)) for r in df.collect())
    assert plain(split) == plain(read_json_array(spark, path, schema))


def test_several_files_of_a_folder_keep_apart(spark, tmp_path, small_blocks):
    for i in range(4):
        _write(tmp_path / f"{i}.json", json.dumps(_records(30, seed=i), indent=i or None))
    _write(tmp_path / "empty.json", "")
    _write(tmp_path / "none.json", "[\n]\n")
    got = json_records(spark, str(tmp_path)).groupBy("_source_file").count()
    assert rows(got) == [(f"{i}.json", 30) for i in range(4)]


def test_nothing_of_a_broken_array_is_lost(spark, tmp_path):
    text = '[{"a":1,"b":"t"}, 5, {"a":2,}, "str", {"a":3,"new":[1]},\n null, {"a":"x"}] trailing'
    got = split_json(json_records(spark, _write(tmp_path / "a.json", text)), _text("a", "b")).collect()
    assert sorted(r.a for r in got if r._status == "accepted") == ["1", "3", "x"]
    assert [dict(r._extra) for r in got if r._extra] == [{"new": "[1]"}]
    assert sorted((r._record, r._reason) for r in got if r._status == "rejected") == [
        ('"str"', "outside of a record"), ("5", "outside of a record"), ("null", "outside of a record"),
        ("trailing", "outside of a record"), ('{"a":2,}', "not a JSON object"),
    ]


def test_a_truncated_file_lands_its_whole_records(spark, tmp_path, small_blocks):
    whole = json.dumps(_records(60), indent=1)
    cut = whole[: whole.rindex('"d"')]
    got = split_json(json_records(spark, _write(tmp_path / "a.json", cut)), _text("d")).collect()
    assert sum(r._status == "accepted" for r in got) == 59
    assert [r._reason for r in got if r._status == "rejected"] == ["not a JSON object"]


def test_ndjson_lines(spark, tmp_path):
    path = _write(tmp_path / "a.ndjson", '{"a": 1}\r\n\r\n{"a": "x", "k": {"y": 1}}\n5\n{"a": \n{"b": 2}')
    got = split_source(spark, path, "ndjson", _text("a", "b")).collect()
    assert sorted(((r.a, r.b) for r in got if r._status == "accepted"), key=str) == [("1", None), ("x", None), (None, "2")]
    assert sorted(r._record for r in got if r._status == "rejected") == ["5", '{"a": ']
    assert json_line_records(spark, path).count() == 5


def test_csv_rows_by_header(spark, tmp_path):
    _write(tmp_path / "1.csv", 'a,b\r\n1,2\r\n3\r\n"x\ny",4\r\n1,2,3\r\n"q,""r",5\r\n')
    _write(tmp_path / "2.csv", "b,n,a,n,a\n2,9,1,8,7\n")
    _write(tmp_path / "3.csv", "﻿a\nonly\n")
    _write(tmp_path / "4.csv", "")
    _write(tmp_path / "5.csv", "a,b\n")
    got = split_source(spark, str(tmp_path / "*.csv"), "csv", _text("a", "b")).collect()
    assert sorted(((r.a, r.b) for r in got if r._status == "accepted"), key=str) == [("1", "2"), ("1", "2"), ("only", None), ('q,"r', "5"), ("x\ny", "4")]
    assert sorted((r._reason, r._record) for r in got if r._status == "rejected") == [("too few fields", "3"), ("too many fields", "1,2,3")]
    assert [dict(r._extra) for r in got if r._extra] == [{"n": "9", "n (2)": "8", "a (2)": "7"}]
    assert sorted(csv_headers(spark, str(tmp_path / "*.csv"))) == [("a",), ("a", "b"), ("b", "n", "a", "n", "a")]
    none = split_source(spark, str(tmp_path / "4.csv"), "csv", _text("a", "b"))
    assert none.count() == 0 and "_reason" in none.columns


def test_landing_reconciles_and_keeps_both_parts(spark, tmp_path):
    (tmp_path / "src").mkdir()
    header = ",".join(RAW["transactions"].names)
    _write(tmp_path / "src" / "transactions.csv", f"{header}\nt1,p1,bet,1,2024-01-01\nt2,p1\nt3,p1,bet,1,2024-01-01,9\n")
    _write(tmp_path / "src" / "players.ndjson", '{"player_id": "p1", "vip": true}\n{"player_id": "p2"}\nbroken\n')
    wanted = (Source("transactions.csv", "transactions", "csv"), Source("players.ndjson", "players", "ndjson"))
    for _ in range(2):  # a repeated load replaces
        landed = landing.land_all(spark, str(tmp_path / "src"), str(tmp_path / "out"), LOADED, sources=wanted)
        assert landed == {"transactions": Landed(3, 1, 2, 0), "players": Landed(3, 2, 1, 1)}
    tx, players = str(tmp_path / "out" / "raw" / "transactions"), str(tmp_path / "out" / "raw" / "players")
    assert rows(landing.accepted(spark, tx), "transaction_id", "_source_file") == [("t1", "transactions.csv")]
    assert rows(landing.rejected(spark, tx), "record", "reason") == [("t2,p1", "too few fields"), ("t3,p1,bet,1,2024-01-01,9", "too many fields")]
    assert [(r.player_id, dict(r.extra)) for r in landing.widened(spark, players).collect()] == [("p1", {"vip": "true"})]
    assert rows(landing.accepted(spark, players), "player_id") == [("p1",), ("p2",)]
    plan = landing.accepted(spark, tx)._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(_status" in plan
    converted = landing.land_all(spark, str(tmp_path / "src"), str(tmp_path / "conv"), LOADED, convert_only=True, sources=wanted)
    assert converted == landed
    lines = [json.loads(x) for f in (tmp_path / "conv" / "ndjson_rejected" / "players").glob("part-*") for x in f.read_text().splitlines()]
    assert [(x["record"], x["reason"]) for x in lines] == [("broken", "not a JSON object")]


def test_a_load_that_does_not_add_up_is_refused(spark, tmp_path, monkeypatch):
    (tmp_path / "src").mkdir()
    _write(tmp_path / "src" / "players.json", '[{"player_id": "p1"}, {"player_id": "p2"}]')
    monkeypatch.setattr(landing, "whole", lambda spark, path: landing.read_full(spark, path).limit(1))
    with pytest.raises(landing.LandingError, match="players"):
        landing.land_source(spark, str(tmp_path / "src"), str(tmp_path / "raw" / "players"), landing.SOURCES[0], LOADED)


def test_fields_of_a_delivery(spark, tmp_path):
    path = _write(tmp_path / "a.json", '[{"a": 1, "b": "x", "n": null}, {"a": 2.5, "b": 1, "o": {}, "l": [], "t": true}]')
    got = source_schema(split_source(spark, path, "json", _text("a", "b")))
    assert rows(got, "column_name", "data_type", "n_rows") == [
        ("a", "number", 2), ("b", "number|text", 2), ("l", "array", 1), ("n", "", 1), ("o", "object", 1), ("t", "boolean", 1)
    ]


def test_registry_versions_and_approval(spark, tmp_path, frame):
    path, contract = str(tmp_path / "schemas"), _text("id", "amount", "note")
    fields = lambda *items: frame("column_name string, data_type string", *items)
    first = fields(("id", "text"), ("amount", "number"), ("note", ""))
    see = lambda observed, day: rows(registry.register(spark, path, "s", observed, contract, f"r{day}", datetime(2024, 1, day)), "column_name", "change")
    assert see(first, 1) == []
    assert see(first, 2) == [] and rows(registry.versions(spark, path, "s").select("version").distinct()) == [(1,)]
    assert see(fields(("id", "text"), ("amount", "number"), ("note", "text")), 3) == []  # a kind where there was none
    retyped = fields(("id", "text"), ("amount", "number|text"), ("extra", "number"))
    for day in (4, 5):  # reported by every run
        assert see(retyped, day) == [("amount", "type_changed"), ("extra", "added"), ("note", "removed")]
    assert see(fields(), 6) == []
    registry.approve(spark, path, "s", 3, datetime(2024, 1, 7))
    assert see(retyped, 8) == []
    assert see(first, 9) == [("amount", "type_changed"), ("extra", "removed"), ("note", "added")]
    assert see(first, 9) and registry.versions(spark, path, "other").isEmpty()


def test_a_first_delivery_that_deviates_is_not_approved(spark, tmp_path, frame):
    path, odd = str(tmp_path / "schemas"), frame("column_name string, data_type string", ("id", "text"), ("x", "text"))
    for day in (1, 2):
        got = registry.register(spark, path, "s", odd, _text("id", "y"), "r", datetime(2024, 1, day))
        assert rows(got, "column_name", "change") == [("x", "added"), ("y", "removed")]


def test_delivery_anomaly(frame):
    schema = "run_id string, run_at timestamp, source string, n_rows bigint"
    runs = lambda source, counts: [(f"{source}{i:02}", f"2024-01-{i + 1:02} 00:00:00", source, n) for i, n in enumerate(counts)]
    history = runs("steady", [100] * 5 + [84, 100]) + runs("noisy", [80, 120, 95, 110, 90, 140, 300]) + runs("young", [5, 500])
    history += runs("empty", [0, 0, 0, 0, 3]) + runs("gone", [50, 50, 50, 0])
    got = rows(delivery_anomaly(frame(schema, *history)), "run_id", "n_rows")
    assert got == [("empty04", 3), ("gone03", 0), ("noisy06", 300), ("steady05", 84)]
    assert rows(delivery_anomaly(frame(schema, *runs("steady", [100] * 5 + [86]))), "run_id") == []


# what a run makes of a delivery


def _arrive(spark, src, out, as_of):
    """The part of the daily run that lands and checks the sources."""
    run = Run(configure(spark), out, DEFAULTS, as_of, uuid.uuid4().hex)
    check_raw(run, landing.land_all(spark, src, out, as_of))
    return run


def _log(run):
    log = run.spark.read.parquet(f"{run.out_dir}/quality_log").where(f"run_id = '{run.run_id}'")
    return {r.check_name: r.status for r in log.collect()}


@pytest.fixture(scope="module")
def steady(spark, tmp_path_factory):
    """Three runs on deliveries of the same size."""
    root = tmp_path_factory.mktemp("steady")
    data = _source(3)
    for day in range(3):
        run = _arrive(spark, _deliver(root / "src", data), str(root / "out"), AS_OF + timedelta(days=day))
    assert all(status == "pass" for name, status in _log(run).items() if name.startswith("raw.") and "newest event" not in name)
    return root, data


def test_a_shrunken_delivery_warns(spark, steady):
    root, data = steady
    less = {**data, "sessions": data["sessions"][:60]}
    log = _log(_arrive(spark, _deliver(root / "src", less), str(root / "out"), AS_OF + timedelta(days=4)))
    assert log["raw.sessions volume"] == "warn" and log["raw.transactions volume"] == "pass"
    assert log["raw.sessions newest event"] == "warn"  # the events are a month old


def test_ragged_and_malformed_rows_warn_and_are_kept(spark, steady):
    root, data = steady
    src = _deliver(root / "src", data)
    with open(f"{src}/transactions.csv", "a") as f:
        f.write("tx_short,pl_1\r\n")
    text = (root / "src" / "players.json").read_text()
    (root / "src" / "players.json").write_text(text.rstrip()[:-1] + ', {"player_id": }]')
    run = _arrive(spark, src, str(root / "out"), AS_OF + timedelta(days=5))
    log = _log(run)
    assert log["raw.transactions rejected rows"] == log["raw.players rejected rows"] == "warn" and log["raw.sessions rejected rows"] == "pass"
    assert rows(landing.rejected(spark, run.path("raw", "transactions")), "record") == [("tx_short,pl_1",)]
    assert run.table("raw", "transactions").count() == len(data["transactions"])
    assert run.table("raw", "players").count() == len(data["players"])


@pytest.mark.parametrize("hours, status", [(1.5, "warn"), (3, "error")])
def test_a_stale_file_turns_the_run(spark, tmp_path, hours, status):
    src = _deliver(tmp_path / "src", _source(5))
    now = datetime.fromtimestamp(os.path.getmtime(f"{src}/sessions.json"))
    as_of = datetime.fromtimestamp(os.path.getmtime(f"{src}/sessions.json"), timezone.utc) + timedelta(minutes=5)
    old = (now + timedelta(minutes=5) - timedelta(hours=hours)).timestamp()
    os.utime(f"{src}/sessions.json", (old, old))
    if status == "error":
        with pytest.raises(QualityError, match="raw.sessions fresh"):
            _arrive(spark, src, str(tmp_path / "out"), as_of)
    else:
        assert _log(_arrive(spark, src, str(tmp_path / "out"), as_of))["raw.sessions fresh"] == status


def test_drift_of_each_kind_stops_the_run_and_loses_nothing(spark, steady):
    root, data = steady
    out = str(root / "out")
    changed = {**data, "players": [{"player_id": p["player_id"], "email": 7, "created_at": p["created_at"], "vip": True} for p in data["players"]]}
    with pytest.raises(QualityError, match="raw.players schema unchanged: 3 failing rows"):
        _arrive(spark, _deliver(root / "src", changed), out, AS_OF + timedelta(days=6))
    assert landing.accepted(spark, f"{out}/raw/players").count() == landing.widened(spark, f"{out}/raw/players").count() == len(data["players"])
    registry.approve(spark, f"{out}/history/schemas", "players", 2, AS_OF)
    run = _arrive(spark, str(root / "src"), out, AS_OF + timedelta(days=7))
    assert _log(run)["raw.players schema unchanged"] == "pass"
