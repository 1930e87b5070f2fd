"""Every check once on rows that pass and once on rows that fail."""

from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import types as T

from tests.conftest import rows
from wagerlens.operators import assertions as a
from wagerlens.operators import discovery as x
from wagerlens.operators import quality as q

TX = "transaction_id string, player_id string, txn_ts timestamp, transaction_type string, amount decimal(18,2)"
AFF = "affiliate_id string, player_id string, clicks bigint, registrations bigint, ftd bigint, cpa_value decimal(18,2)"


def test_unique(frame):
    df = frame("a string, b string", ("x", "1"), ("x", "2"), (None, "1"), (None, "1"))
    assert rows(q.unique(df, ["a"])) == [("x", 2)]
    assert rows(q.unique(df, ["a", "b"])) == []


def test_not_null(frame):
    df = frame("a string", ("x",), (None,))
    assert q.not_null(df, "a").count() == 1
    assert q.not_null(df.where("a = 'x'"), "a").count() == 0


def test_accepted_values(frame):
    df = frame("a string", ("x",), ("y",), ("y",), (None,))
    assert rows(q.accepted_values(df, "a", ["x"])) == [("y", 2)]
    assert rows(q.accepted_values(df, "a", ["x", "y"])) == []


def test_relationships(frame):
    child, parent = frame("fk string", ("x",), ("y",), ("y",), (None,)), frame("pk string", ("x",))
    assert rows(q.relationships(child, "fk", parent, "pk")) == [("y", 2)]
    assert rows(q.relationships(child.where("fk = 'x'"), "fk", parent, "pk")) == []


def test_between(frame):
    df = frame("n bigint", (-1,), (0,), (5,), (6,), (None,))
    assert rows(q.between(df, "n", 0, 5)) == [(-1,), (6,)]
    assert rows(q.between(df, "n", lo=0)) == [(-1,)]
    assert rows(q.between(df, "n", hi=5)) == [(6,)]
    assert rows(q.between(df, "n")) == []


def test_contract(frame):
    contract = T.StructType([T.StructField("a", T.StringType()), T.StructField("n", T.LongType())])
    assert q.enforce_contract(frame("n bigint, a string", (1, "x")), contract).columns == ["a", "n"]
    for schema, row in (("a string", ("x",)), ("a string, n int", ("x", 1)), ("a string, n bigint, z int", ("x", 1, 1))):
        with pytest.raises(q.ContractError):
            q.enforce_contract(frame(schema, row), contract)


def test_freshness(frame):
    df = frame("ts timestamp", ("2024-01-01 00:00:00",))
    hour = timedelta(hours=1)

    def status(hours):
        return q.freshness({"s": (df, "ts", 25 * hour, 48 * hour)}, datetime(2024, 1, 1) + hours * hour).first().status

    assert [status(h) for h in (1, 25, 26, 48, 49)] == ["pass", "pass", "warn", "warn", "error"]
    empty = q.freshness({"s": (df.limit(0), "ts", hour, hour)}, datetime(2024, 1, 1)).first()
    assert (empty.status, empty.max_loaded_at) == ("error", None)


def test_schema_changes(spark, frame):
    before = q.schema_frame(spark, frame("a string, b int, c int", ("x", 1, 1)))
    after = q.schema_frame(spark, frame("a string, b bigint, d int", ("x", 1, 1)))
    assert rows(q.schema_changes(after, before)) == [
        ("b", "type_changed", "int", "bigint"), ("c", "removed", "int", None), ("d", "added", None, "int")
    ]
    assert rows(q.schema_changes(before, before)) == []


def test_volume_anomaly(spark, frame):
    start = datetime(2024, 1, 1)
    counts = [10 + (i % 3) for i in range(20)]
    counts[16], counts[18] = 60, 0
    df = spark.createDataFrame(
        [(start + timedelta(days=d),) for d, n in enumerate(counts) for _ in range(n)], "ts timestamp"
    )
    # The spike also widens the norm of the days after it, so the empty day passes.
    assert rows(q.volume_anomaly(df, "ts", train=10), "day", "n_rows") == [(date(2024, 1, 17), 60)]
    assert q.volume_anomaly(df.where("ts < '2024-01-15'"), "ts", train=10).count() == 0
    quiet = [n if i != 16 else 10 for i, n in enumerate(counts)]
    df = spark.createDataFrame([(start + timedelta(days=d),) for d, n in enumerate(quiet) for _ in range(n)], "ts timestamp")
    assert rows(q.volume_anomaly(df, "ts", train=10), "day", "n_rows") == [(date(2024, 1, 19), 0)]


def test_suite_and_log(spark, frame, tmp_path):
    bad, good = frame("n bigint", (1,), (2,)), frame("n bigint", (1,)).limit(0)
    warned = q.run_suite([q.Check("a", "warn", bad), q.Check("b", "error", good)])
    assert rows(warned) == [("a", "warn", 2, "warn"), ("b", "error", 0, "pass")]
    q.raise_on_error(warned)
    mixed = q.run_suite([
        q.RowCheck("r1", "error", bad, bad.n > 1), q.Check("a", "warn", bad), q.RowCheck("r2", "warn", bad, bad.n > 0),
        q.RowCheck("r3", "error", bad, bad.n > 5),
    ])
    assert rows(mixed) == [("a", "warn", 2, "warn"), ("r1", "error", 1, "error"), ("r2", "warn", 2, "warn"), ("r3", "error", 0, "pass")]
    with pytest.raises(q.QualityError, match="c: 2 failing rows"):
        q.raise_on_error(q.run_suite([q.Check("c", "error", bad)]))
    for run in ("r1", "r2"):
        q.log_results(warned, str(tmp_path / "log"), run, datetime(2024, 1, 1))
    log = spark.read.parquet(str(tmp_path / "log"))
    assert rows(log.groupBy("run_id").count()) == [("r1", 2), ("r2", 2)]


def test_pass_rates(frame):
    df = frame("n bigint", (1,), (2,), (-1,), (5,))
    from pyspark.sql import functions as F

    assert rows(q.pass_rates({"positive": (df, F.col("n") > 0)})) == [("positive", 0.75)]


def test_source_assertions(frame):
    tx = frame(TX, ("t1", "p", "2024-01-01 00:00:00", "bet", 0), ("t2", "p", "2024-01-03 00:00:00", "bet", 1), ("t3", "p", None, "bet", None))
    assert rows(a.amount_positive(tx)) == [("t1", 0)]
    aff = frame(AFF, ("a", "p1", 5, 4, 3, 1), ("a", "p2", 5, 6, 7, 1), ("a", "p3", -5, 0, 0, None))
    assert rows(a.counts_non_negative(aff), "player_id") == [("p3",)]
    assert rows(a.ftd_within_registrations(aff), "player_id") == [("p2",)]
    assert rows(a.registrations_within_clicks(aff), "player_id") == [("p2",), ("p3",)]
    sessions = frame("session_id string, session_ts timestamp", ("s1", "2024-01-02 00:00:01"))
    assert rows(a.no_future_timestamps(sessions, tx, datetime(2024, 1, 2)), "model", "id") == [
        ("stg_sessions", "s1"), ("stg_transactions", "t2")
    ]


def test_ledger_assertions(frame):
    tx = frame(TX, ("t1", "p", "2024-01-01 00:00:00", "deposit", 5), ("t2", "q", "2024-01-01 23:00:00", "bet", 5))
    assert rows(a.first_transaction_is_deposit(tx)) == [("q", "bet")]
    people = frame("player_id string, created_at date", ("p", "2024-01-01"), ("q", "2024-01-02"))
    assert rows(a.no_transaction_before_created(tx, people), "transaction_id") == [("t2",)]
    fact = frame(
        "transaction_id string, player_id string, txn_ts timestamp, signed_amount decimal(18,2), running_balance decimal(18,2)",
        ("t1", "p", "2024-01-01 00:00:00", 5, 5), ("t2", "p", "2024-01-02 00:00:00", -2, 4),
    )
    assert rows(a.running_balance_reconciles(fact)) == [("t2", 4, 3)]


def test_mart_assertions(frame):
    qualified = frame(
        "player_id string, first_deposit_ts timestamp, total_bets decimal(18,2), is_qualified boolean",
        ("ok", "2024-01-01 00:00:00", 50, True), ("few", "2024-01-01 00:00:00", 49, True),
        ("none", None, 99, True), ("no", None, 1, False),
    )
    assert rows(a.qualified_has_deposit_and_baseline(qualified), "player_id") == [("few",), ("none",)]
    perf = frame("affiliate_id string, qualified_ftds bigint", ("a", 1), ("b", 1))
    assert a.cpa_only_for_qualified(perf, frame("player_id string", ("p",), ("q",))).count() == 0
    assert rows(a.cpa_only_for_qualified(perf, frame("player_id string", ("p",)))) == [(2, 1)]
    people = frame("player_id string", ("p",), ("q",))
    assert rows(a.every_player_has_profile(people, people.where("player_id = 'p'"))) == [("q",)]
    flags = "player_id string, risk_score bigint, s_ghost_ftd boolean, s_aml_low_play boolean, s_ip_velocity boolean, s_ledger_anomaly boolean, s_net_negative boolean"
    fraud = frame(flags, ("p", 2, True, False, True, False, False), ("q", 2, True, False, False, False, False))
    assert rows(a.risk_score_matches_flags(fraud)) == [("q", 2)]


def test_fanout_is_what_the_join_would_give(frame):
    left = frame("k string, v decimal(18,2)", ("a", 1), ("a", 2), ("b", 5), ("c", 7), (None, 1))
    right = frame("k string", ("a",), ("a",), ("a",), ("b",), ("z",), (None,))
    joined = left.join(right, "k", "left")
    got = x.join_fanout(left, right, "k", "v").first()
    assert (got.rows_before, got.sum_before) == (5, 16)
    assert got.rows_after == joined.count() and got.sum_after == joined.agg({"v": "sum"}).first()[0] == Decimal("22")


def test_offset_markers(frame):
    df = frame("t string", ("2024-01-15",), ("2024-01-15T10:00:00Z",), ("2024-01-15 10:00:00+02:00",), ("2024-01-15 10:00:00.123",), (None,))
    assert rows(x.ts_text_audit({"s": (df, "t")}), "granularity", "has_offset", "n_rows") == [
        ("date-only", False, 1), ("second", True, 2), ("sub-second", False, 1)
    ]


def test_column_profile(frame):
    df = frame("s string, n bigint, e string", ("b", 1, None), ("a", 3, None), ("b", None, None))
    got = {r.column_name: r.asDict() for r in x.column_profile(df).collect()}
    assert (got["s"]["n_distinct"], got["s"]["examples"], got["s"]["categories"]) == (2, "a|b", "a=1|b=2")
    assert (got["n"]["n_nulls"], got["n"]["min_value"], got["n"]["mean_value"], got["n"]["categories"]) == (1, 1.0, 2.0, None)
    assert (got["e"]["n_nulls"], got["e"]["n_distinct"], got["e"]["examples"]) == (3, 0, None)


def test_slo_sees_that_every_session_is_an_orphan(frame):
    players = frame("player_id string, created_at date", ("p1", "2024-01-01"))
    tx = frame("player_id string, amount decimal(18,2)", ("p1", "5"))
    sessions = frame("player_id string", ("x",), (None,))
    aff = frame("ftd bigint, registrations bigint", (1, 2))
    moves = frame("player_id string, txn_date date", ("p1", "2024-01-02"))
    got = {r.rule: r.pass_rate for r in q.slo_pass_rates(players, tx, sessions, aff, moves).collect()}
    assert got["referential integrity"] == 0.0
    whole = {r.rule: r.pass_rate for r in q.slo_pass_rates(players, tx, sessions.limit(0), aff, moves).collect()}
    assert set(whole.values()) == {1.0}
