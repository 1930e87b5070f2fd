import json
from datetime import datetime

import pytest

from wagerlens.schemas import RAW, _text
from wagerlens.sinks.tables import read_full
from wagerlens.sources import audit
from wagerlens.sources.landing import Landed, land_all, land_full, to_ndjson, with_audit
from wagerlens.sources.readers import CORRUPT, read_csv_strings, read_json_array

LOADED = datetime(2024, 2, 1, 6)


def _lines(folder):
    return [line for part in sorted(folder.glob("part-*")) for line in part.read_bytes().split(b"\n") if line]


def _write(path, text):
    path.write_bytes(text.encode() if isinstance(text, str) else text)
    return str(path)


def test_csv_rows_are_text(spark, tmp_path):
    path = _write(tmp_path / "a.csv", "a,b\n1,2\n3,4\n")
    assert [tuple(r) for r in read_csv_strings(spark, path, _text("a", "b")).collect()] == [("1", "2"), ("3", "4")]


def test_json_array_rows(spark, tmp_path):
    path = _write(tmp_path / "a.json", '[{"a":1},{"a":2}]')
    assert [r.a for r in read_json_array(spark, path, _text("a")).collect()] == ["1", "2"]


def test_csv_ragged_quoted_and_crlf(spark, tmp_path):
    path = _write(tmp_path / "a.csv", 'a,b\r\n1\r\n1,2,3\r\n"x\ny",4\r\n')
    got = read_csv_strings(spark, path, _text("a", "b"), keep_ragged=True).collect()
    assert [(r.a, r.b) for r in got] == [("1", None), ("1", "2"), ("x\ny", "4")]
    assert [r[CORRUPT] is not None for r in got] == [True, True, False]


def test_csv_header_must_match(spark, tmp_path):
    path = _write(tmp_path / "a.csv", "b,a\n1,2\n")
    with pytest.raises(Exception, match="CSV header does not conform"):
        read_csv_strings(spark, path, _text("a", "b")).collect()


def test_ndjson_count_audit_and_nulls(spark, tmp_path):
    path = _write(tmp_path / "players.json", json.dumps([{"player_id": "p1", "email": "é"}, {"player_id": "p2"}], indent=1))
    df = with_audit(read_json_array(spark, path, RAW["players"]), LOADED)
    assert to_ndjson(df, str(tmp_path / "out")) == 2
    records = [json.loads(line) for line in _lines(tmp_path / "out")]
    assert {r["_source_file"] for r in records} == {"players.json"}
    assert len({r["_ingested_at"] for r in records}) == 1
    assert records[0]["email"] == "é"
    assert all(set(r) == {"player_id", "email", "city", "created_at", "_ingested_at", "_source_file"} for r in records)
    assert records[1]["email"] is None


def test_ndjson_uses_lf_only(spark, tmp_path):
    path = _write(tmp_path / "a.csv", "a,b\r\n1,2\r\n3,4\r\n")
    to_ndjson(read_csv_strings(spark, path, _text("a", "b")), str(tmp_path / "out"))
    lines = _lines(tmp_path / "out")
    assert len(lines) == 2 and not any(b"\r" in line for line in lines)


def test_three_records_three_lines(spark, tmp_path):
    path = _write(tmp_path / "a.json", '[{"a": 1},\n {"a": 2},\n {"a": 3}]')
    assert to_ndjson(read_json_array(spark, path, _text("a")), str(tmp_path / "out")) == 3
    assert [json.loads(line)["a"] for line in _lines(tmp_path / "out")] == ["1", "2", "3"]


def test_landing_again_replaces(spark, tmp_path):
    path = _write(tmp_path / "a.json", '[{"a": 1}, {"a": 2}]')
    df = read_json_array(spark, path, _text("a"))
    for _ in range(3):
        assert land_full(df, str(tmp_path / "t")) == 2
    assert read_full(spark, str(tmp_path / "t")).count() == 2
    assert len(list((tmp_path / "t").glob("snap-*"))) <= 3


def test_land_all_convert_only(spark, tmp_path):
    src = tmp_path / "src"
    src.mkdir()
    for name in ("players", "sessions"):
        _write(src / f"{name}.json", json.dumps([{c: "1" for c in RAW[name].names}]))
    for name in ("transactions", "affiliate_cpa_ftd"):
        _write(src / f"{name}.csv", ",".join(RAW[name].names) + "\n" + ",".join("1" for _ in RAW[name].names) + "\n")
    counts = land_all(spark, str(src), str(tmp_path / "out"), LOADED, convert_only=True)
    assert counts == {name: Landed(1, 1, 0, 0) for name in RAW}
    assert not (tmp_path / "out" / "raw").exists()
    assert len(_lines(tmp_path / "out" / "ndjson" / "sessions")) == 1


def test_file_audit(spark, tmp_path):
    paths = [
        _write(tmp_path / "bom.csv", b"\xef\xbb\xbfa,b\n1,2\n"),
        _write(tmp_path / "bom_open.csv", b"\xef\xbb\xbfa,b\n1,2"),
        _write(tmp_path / "crlf.csv", b"a,b\r\n1,2\r\n"),
        _write(tmp_path / "latin.csv", b"a\n\xff\n"),
        _write(tmp_path / "open.json", b"\n  [\n{}]"),
    ]
    got = {r.file_name: (r.size_bytes, r.has_bom, r.has_crlf, r.valid_utf8, r.first_char) for r in audit.file_audit(spark, paths).collect()}
    assert got == {
        "bom.csv": (11, True, False, True, "a"),
        "bom_open.csv": (10, True, False, True, "a"),
        "crlf.csv": (10, False, True, True, "a"),
        "latin.csv": (4, False, False, False, "a"),
        "open.json": (8, False, False, True, "["),
    }


def test_json_record_audit(spark, tmp_path):
    path = _write(tmp_path / "a.json", '[{"a": 1, "b": "[x"}, {"b": "y", "a": {"z": 1}}, {"a": null, "1bad": [1], "_source_file": ""}]')
    sets = audit.json_record_audit(spark, path)
    assert sorted(tuple(r) for r in sets.collect()) == [("1bad,_source_file,a", 1, 1), ("a,b", 2, 1)]
    names = {r.name: (r.is_valid, r.clashes_with_audit) for r in audit.json_name_audit(sets).collect()}
    assert names == {"a": (True, False), "b": (True, False), "1bad": (False, False), "_source_file": (True, True)}


def test_json_record_audit_of_a_file_in_many_tasks(spark, tmp_path):
    """Records over several lines and blocks are read once each; what is no object is counted, not lost."""
    records = [{"id": i, "note": "x" * (i % 90) + '"}],{[', **({"more": [i]} if i % 7 == 0 else {})} for i in range(2000)]
    path = _write(tmp_path / "big.json", json.dumps(records, indent=1)[:-1].rstrip() + ',\n 5,\n {"id": }\n]')
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        assert spark.read.text(path).rdd.getNumPartitions() > 3
        sets = {r.key_set: (r.n_rows, r.n_nested) for r in audit.json_record_audit(spark, path).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sets == {"id,note": (1714, 0), "id,more,note": (286, 286), None: (2, 0)}


def test_csv_record_audit_of_a_file_without_a_line(spark, tmp_path):
    got = audit.csv_record_audit(spark, _write(tmp_path / "none.csv", "")).first()
    assert (got.n_columns, got.n_rows, got.ragged_rows, got.invalid_names) == (0, 0, 0, "")


def test_csv_record_audit(spark, tmp_path):
    path = _write(tmp_path / "a.csv", 'a;b c;_ingested_at\r\n1;2;3\r\n1\r\n"x\ny";2;"z\n"\r\n1;2;3;4\r\n')
    got = audit.csv_record_audit(spark, path).first().asDict()
    assert got == {
        "delimiter": ";", "n_columns": 3, "n_rows": 4, "ragged_rows": 2, "embedded_newline_fields": 2,
        "invalid_names": "b c", "audit_clashes": "_ingested_at",
    }


def test_file_audit_keeps_files_of_one_name_and_empty_ones(spark, tmp_path):
    for folder in ("a", "b c"):
        (tmp_path / folder).mkdir()
    paths = [
        _write(tmp_path / "a" / "x.csv", b"a\n1\n"), _write(tmp_path / "b c" / "x.csv", b"\xef\xbb\xbfa\n"),
        _write(tmp_path / "none.csv", b""),
    ]
    got = sorted((r.file_name, r.size_bytes, r.has_bom, r.first_char) for r in audit.file_audit(spark, paths).collect())
    assert got == [("none.csv", 0, False, None), ("x.csv", 4, False, "a"), ("x.csv", 5, True, "a")]
