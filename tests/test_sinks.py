from datetime import date

import pytest

from tests.conftest import rows
from wagerlens.operators.incremental import incremental_window, merge_upsert, overwrite_partitions, union_evolve
from wagerlens.sinks import facts, tables

FACT = "id string, player string, ts timestamp, day date, v bigint"


def _fact(frame, *items):
    return frame(FACT, *[(i, p, ts, ts[:10], v) for i, p, ts, v in items])


@pytest.fixture
def loaded(spark, frame, tmp_path):
    path = str(tmp_path / "fact")
    facts.write_fact(
        _fact(frame, ("a", "p1", "2024-01-01 10:00:00", 1), ("b", "p2", "2024-01-02 10:00:00", 2), ("c", "p1", "2024-01-05 10:00:00", 3)),
        path, "day", "player", "id",
    )
    return path


def _state(spark, path):
    return rows(facts.read_fact(spark, path, "day"), "id", "day", "v")


def test_full_write_can_read_itself_and_keeps_one_previous(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    tables.write_full(frame("n bigint", (1,)), path)
    for _ in range(3):
        tables.write_full(tables.read_full(spark, path).selectExpr("n + 1 as n"), path)
    assert rows(tables.read_full(spark, path)) == [(4,)]


def test_incomplete_snapshot_is_ignored(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    tables.write_full(frame("n bigint", (1,)), path)
    (tmp_path / "t" / "snap-00000002").mkdir()
    assert rows(tables.read_full(spark, path)) == [(1,)]
    tables.write_full(frame("n bigint", (2,)), path)
    assert rows(tables.read_full(spark, path)) == [(2,)]
    with pytest.raises(FileNotFoundError):
        tables.read_full(spark, str(tmp_path / "none"))


def test_fact_is_partitioned_by_day(spark, loaded, tmp_path):
    assert sorted(p.name for p in (tmp_path / "fact" / "data").glob("day=*")) == ["day=2024-01-01", "day=2024-01-02", "day=2024-01-05"]
    plan = facts.read_fact(spark, loaded, "day").where("day = '2024-01-02'")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(day" in plan


def test_a_hot_day_is_spread_over_files(spark, frame, tmp_path):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        one_day = _fact(frame, *[(f"i{i:03}", "p", "2024-01-01 10:00:00", i) for i in range(200)])
        facts.write_fact(one_day, str(tmp_path / "f"), "day", "player", "id")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(list((tmp_path / "f" / "data" / "day=2024-01-01").glob("version=*/*.parquet"))) > 1


def test_merge_updates_inserts_keeps_and_repeats(spark, frame, loaded):
    batch = _fact(frame, ("c", "p1", "2024-01-05 10:00:00", 30), ("d", "p3", "2024-01-06 10:00:00", 4))
    for _ in range(2):
        facts.merge_into_path(batch, loaded, "id", "day", "player")
        assert _state(spark, loaded) == [
            ("a", date(2024, 1, 1), 1), ("b", date(2024, 1, 2), 2), ("c", date(2024, 1, 5), 30), ("d", date(2024, 1, 6), 4)
        ]


def test_merge_moves_a_key_and_removes_the_empty_day(spark, frame, loaded, tmp_path):
    facts.merge_into_path(_fact(frame, ("b", "p2", "2024-01-03 10:00:00", 9)), loaded, "id", "day", "player")
    assert _state(spark, loaded) == [("a", date(2024, 1, 1), 1), ("b", date(2024, 1, 3), 9), ("c", date(2024, 1, 5), 3)]
    assert date(2024, 1, 2) not in facts.days(spark, loaded)


def test_merge_leaves_other_days_untouched(spark, frame, loaded, tmp_path):
    files_of = lambda: {str(p) for p in (tmp_path / "fact" / "data" / "day=2024-01-01").glob("version=*/*.parquet")}
    before, version = files_of(), facts.days(spark, loaded)[date(2024, 1, 1)]
    facts.merge_into_path(_fact(frame, ("c", "p1", "2024-01-05 10:00:00", 30)), loaded, "id", "day", "player")
    assert files_of() == before and facts.days(spark, loaded)[date(2024, 1, 1)] == version


def test_merge_rejects_a_repeated_key(frame, loaded):
    batch = _fact(frame, ("x", "p", "2024-01-05 10:00:00", 1), ("x", "p", "2024-01-06 10:00:00", 1))
    with pytest.raises(facts.DuplicateKeyError):
        facts.merge_into_path(batch, loaded, "id", "day", "player")


def test_merge_appends_a_new_column(spark, frame, loaded):
    batch = _fact(frame, ("d", "p3", "2024-01-06 10:00:00", 4)).selectExpr("*", "'web' as channel")
    facts.merge_into_path(batch, loaded, "id", "day", "player")
    assert rows(facts.read_fact(spark, loaded, "day"), "id", "channel") == [("a", None), ("b", None), ("c", None), ("d", "web")]


def test_overwrite_replaces_only_its_days(spark, frame, loaded):
    for _ in range(2):
        facts.overwrite_days(_fact(frame, ("z", "p9", "2024-01-05 10:00:00", 7)), loaded, "day", "player", "id")
        assert _state(spark, loaded) == [("a", date(2024, 1, 1), 1), ("b", date(2024, 1, 2), 2), ("z", date(2024, 1, 5), 7)]


def test_pure_forms(frame):
    target = frame("id string, day string, v bigint", ("a", "d1", 1), ("b", "d1", 2), ("c", "d2", 3))
    source = frame("id string, day string, v bigint", ("b", "d1", 20), ("n", "d3", 9))
    assert rows(merge_upsert(target, source, "id"), "id", "v") == [("a", 1), ("b", 20), ("c", 3), ("n", 9)]
    assert rows(overwrite_partitions(target, source, "day"), "id", "v") == [("b", 20), ("c", 3), ("n", 9)]
    wide = union_evolve(target.select("id"), source)
    assert rows(wide, "id", "v") == [("a", None), ("b", 20), ("b", None), ("c", None), ("n", 9)]


def test_window_goes_back_from_the_newest_instant_or_day(frame):
    source = frame("ts timestamp", ("2024-01-02 11:59:59",), ("2024-01-02 12:00:00",), ("2024-01-09 00:00:00",))
    instants = frame("ts timestamp", ("2024-01-05 12:00:00",), ("2024-01-01 00:00:00",))
    assert incremental_window(source, instants, "ts", "ts").count() == 2
    days = frame("day date", ("2024-01-05",))
    assert incremental_window(source, days, "ts", "day").count() == 3
    assert incremental_window(source, instants.limit(0), "ts", "ts").count() == 0


def test_newest_day_opens_no_other(spark, loaded):
    newest = facts.newest_day(spark, loaded, "day")
    assert rows(newest, "id") == [("c",)]
    assert all("day=2024-01-05" in f for f in newest.inputFiles())
    # also where the files of older days cannot be read at all
    for file in (f for f in facts.read_fact(spark, loaded, "day").inputFiles() if "day=2024-01-05" not in f):
        with open(file.removeprefix("file://").removeprefix("file:"), "wb") as broken:
            broken.write(b"not parquet")
    schema = facts.newest_day(spark, loaded, "day").schema
    assert rows(facts.newest_day(spark, loaded, "day", schema), "id") == [("c",)]
    assert rows(facts.read_fact(spark, loaded, "day", schema, since=date(2024, 1, 3)), "id") == [("c",)]


class Stopped(Exception):
    """A load that ends between its data and its switch."""


def _stop(*args, **kwargs):
    raise Stopped


LOADS = {
    "full": lambda df, path: facts.write_fact(df, path, "day", "player", "id"),
    "overwrite": lambda df, path: facts.overwrite_days(df, path, "day", "player", "id"),
    "merge": lambda df, path: facts.merge_into_path(df, path, "id", "day", "player"),
}
AFTER = {
    "full": [("c", date(2024, 1, 6), 30), ("n", date(2024, 1, 1), 8)],
    "overwrite": [("b", date(2024, 1, 2), 2), ("c", date(2024, 1, 5), 3), ("c", date(2024, 1, 6), 30), ("n", date(2024, 1, 1), 8)],
    "merge": [("a", date(2024, 1, 1), 1), ("b", date(2024, 1, 2), 2), ("c", date(2024, 1, 6), 30), ("n", date(2024, 1, 1), 8)],
}


@pytest.mark.parametrize("kind", sorted(LOADS))
@pytest.mark.parametrize("where", ["before the manifest", "in the manifest", "in the data"])
def test_a_stopped_load_changes_nothing_and_can_be_repeated(spark, frame, loaded, monkeypatch, kind, where):
    """A key that moves from one day to another is in neither state lost or doubled."""
    before, valid = _state(spark, loaded), facts.days(spark, loaded)
    batch = _fact(frame, ("c", "p1", "2024-01-06 10:00:00", 30), ("n", "p1", "2024-01-01 11:00:00", 8))
    with monkeypatch.context() as m:
        if where == "before the manifest":
            m.setattr(facts, "_switch", _stop)
        elif where == "in the manifest":  # files are there, the mark of completion is not
            whole = tables.write_full

            def half(df, path):
                whole(df, path)
                newest = sorted((tables.files.child_names(spark, path)))[-1]
                tables.files.remove_tree(spark, f"{path}/{newest}/_SUCCESS")
                raise Stopped

            m.setattr(facts.tables, "write_full", half)
        else:
            m.setattr(facts.files, "child_names", _stop)  # the first thing done with the files written
        with pytest.raises(Stopped):
            LOADS[kind](batch, loaded)
    assert _state(spark, loaded) == before and facts.days(spark, loaded) == valid
    for _ in range(2):
        LOADS[kind](batch, loaded)
        assert _state(spark, loaded) == AFTER[kind]
    facts.vacuum(spark, loaded, "day")
    assert _state(spark, loaded) == AFTER[kind]


def test_readers_on_the_state_before_keep_it(spark, frame, loaded):
    held = facts.read_fact(spark, loaded, "day")
    facts.merge_into_path(_fact(frame, ("b", "p2", "2024-01-02 12:00:00", 20)), loaded, "id", "day", "player")
    facts.vacuum(spark, loaded, "day")
    assert rows(held, "id", "v") == [("a", 1), ("b", 2), ("c", 3)]
    first, second = facts.loads(spark, loaded)
    assert rows(facts.read_fact(spark, loaded, "day", load=first), "id", "v") == [("a", 1), ("b", 2), ("c", 3)]
    assert rows(facts.read_fact(spark, loaded, "day", load=second), "id", "v") == [("a", 1), ("b", 20), ("c", 3)]


def test_vacuum_removes_what_no_kept_manifest_names(spark, frame, loaded, tmp_path):
    folders = lambda: {str(p.relative_to(tmp_path)) for p in (tmp_path / "fact" / "data").glob("day=*/version=*")}
    for v in range(4):
        facts.overwrite_days(_fact(frame, ("a", "p1", "2024-01-01 10:00:00", v)), loaded, "day", "player", "id")
    assert len(folders()) == 3 + 4
    assert facts.vacuum(spark, loaded, "day") == 3  # the first load's day, and those of two loads before the last two
    assert len(folders()) == 4
    facts.merge_into_path(_fact(frame, ("c", "p1", "2024-01-01 12:00:00", 3)), loaded, "id", "day", "player")
    facts.merge_into_path(_fact(frame, ("d", "p1", "2024-01-01 12:00:00", 4)), loaded, "id", "day", "player")
    facts.vacuum(spark, loaded, "day")
    assert not (tmp_path / "fact" / "data" / "day=2024-01-05").exists()
    assert _state(spark, loaded) == [("a", date(2024, 1, 1), 3), ("b", date(2024, 1, 2), 2), ("c", date(2024, 1, 1), 3), ("d", date(2024, 1, 1), 4)]


@pytest.mark.parametrize("kind", sorted(LOADS))
def test_rows_without_a_day_are_refused_by_name(spark, frame, loaded, kind, tmp_path):
    before = _state(spark, loaded)
    folders = lambda: sorted(str(p) for p in (tmp_path / "fact" / "data").glob("day=*/version=*"))
    kept = folders()
    batch = frame(FACT, ("x", "p", None, None, 1), ("y", "p", "2024-01-05 10:00:00", "2024-01-05", 2), ("z", "p", None, None, 1))
    with pytest.raises(facts.MissingDayError, match="2 row.s. have no day"):
        LOADS[kind](batch, loaded)
    assert _state(spark, loaded) == before and folders() == kept


def test_two_loads_on_one_state_do_not_lose_rows(spark, frame, loaded, monkeypatch):
    """The load that switches second learns that its view of the table was old."""
    mine, theirs = (_fact(frame, (i, "p9", f"2024-01-0{d} 10:00:00", 9)) for i, d in (("m", 7), ("t", 8)))
    switch = facts._switch

    def late(*args):
        monkeypatch.setattr(facts, "_switch", switch)
        facts.merge_into_path(theirs, loaded, "id", "day", "player")
        switch(*args)

    monkeypatch.setattr(facts, "_switch", late)
    with pytest.raises(facts.ConcurrentLoadError):
        facts.merge_into_path(mine, loaded, "id", "day", "player")
    facts.merge_into_path(mine, loaded, "id", "day", "player")
    assert [r[0] for r in _state(spark, loaded)] == ["a", "b", "c", "m", "t"]


def test_empty_loads(spark, frame, loaded, tmp_path):
    none = _fact(frame, ("a", "p", "2024-01-01 10:00:00", 1)).limit(0)
    before = _state(spark, loaded)
    facts.overwrite_days(none, loaded, "day", "player", "id")
    facts.merge_into_path(none, loaded, "id", "day", "player")
    assert _state(spark, loaded) == before
    path = str(tmp_path / "new")
    assert not facts.exists(spark, path)
    facts.write_fact(none, path, "day", "player", "id")
    assert facts.exists(spark, path) and facts.days(spark, path) == {}
    assert facts.read_fact(spark, path, "day", none.schema).count() == 0 and facts.newest_day(spark, path, "day", none.schema).count() == 0
    facts.merge_into_path(_fact(frame, ("a", "p", "2024-01-01 10:00:00", 1)), path, "id", "day", "player", none.schema)
    assert _state(spark, path) == [("a", date(2024, 1, 1), 1)]


def test_manifest_tells_rows(spark, loaded):
    assert rows(facts.manifest(spark, loaded), "day", "n_rows") == [(date(2024, 1, d), 1) for d in (1, 2, 5)]
