"""Day-partitioned facts whose days change all at once: versioned day folders and a manifest that names the valid ones.

A table is a folder with two parts:

* `data/<part>=<day>/version=<v>/`: the rows of a day as one load left them. Never changed once written.
* `manifest/`: a full-refresh table (`tables.write_full`) with a row for each day: day, version, n_rows.

A load writes new day folders, then one new manifest. The manifest's completion is the switch: whoever reads before
it sees every day as it was, whoever reads after it sees every day as it became, and a load that stopped
anywhere in between has changed nothing. What no manifest names any more is cleared by `vacuum`.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wagerlens.operators.incremental import union_evolve
from wagerlens.operators.quality import unique
from wagerlens.sinks import files, tables

VERSION = "version"
_MANIFEST = "day date, version string, n_rows bigint"


class DuplicateKeyError(ValueError):
    """A merge source holds a key twice."""


class MissingDayError(ValueError):
    """Rows without a day cannot be placed in a day-partitioned table."""


class ConcurrentLoadError(RuntimeError):
    """Another load switched the manifest since this one read it."""


def _data(path: str) -> str:
    return f"{path}/data"


def _manifest(path: str) -> str:
    return f"{path}/manifest"


def manifest(spark: SparkSession, path: str, load: int | None = None) -> DataFrame:
    """(day, version, n_rows) of the valid day folders; `load` takes an earlier manifest that is still kept."""
    return tables.read_full(spark, _manifest(path), load)


def loads(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the manifests that are kept, oldest first."""
    return tables.snapshot_numbers(spark, _manifest(path))


def exists(spark: SparkSession, path: str) -> bool:
    return bool(loads(spark, path))


def days(spark: SparkSession, path: str, load: int | None = None) -> dict[date, str]:
    """Day -> version. One row for each calendar day of history reaches the driver."""
    return {r.day: r.version for r in manifest(spark, path, load).collect()}


def _laid_out(df: DataFrame, part: str, cluster: str, key: str) -> DataFrame:
    """Rows ranged over (day, cluster, key): a day of any size spreads over tasks and files, each
    holding a narrow range of the cluster column for row-group skipping."""
    return df.repartitionByRange(part, cluster, key).sortWithinPartitions(part, cluster)


def _folders(path: str, part: str, valid: dict[date, str]) -> list[str]:
    return [f"{_data(path)}/{part}={day.isoformat()}/{VERSION}={version}" for day, version in sorted(valid.items())]


def _read_days(spark: SparkSession, path: str, part: str, valid: dict[date, str], schema: T.StructType | None) -> DataFrame:
    """The rows of the given day folders, and of no other: one scan, whatever the number of versions."""
    if not valid:
        if schema is None:
            raise ValueError("an empty table has no schema of its own; pass one")
        return spark.createDataFrame([], schema)
    reader = spark.read.option("basePath", _data(path))
    if schema is not None:
        reader = reader.schema(T.StructType([*schema.fields, T.StructField(VERSION, T.StringType())]))
    else:
        reader = reader.option("mergeSchema", "true")
    found = reader.parquet(*_folders(path, part, valid)).drop(VERSION)
    return found.withColumn(part, F.col(part).cast("date")) if dict(found.dtypes)[part] != "date" else found


def read_fact(
    spark: SparkSession, path: str, part: str, schema: T.StructType | None = None, since: date | None = None, load: int | None = None
) -> DataFrame:
    """The table as its newest manifest (or the one numbered `load`) has it; `since` leaves out older days unopened.

    With a known schema no file is opened to find out; without one, the schemas of all files are merged,
    which is a job over every footer. Days written before a column was added have NULL there.
    """
    valid = {d: v for d, v in days(spark, path, load).items() if since is None or d >= since}
    return _read_days(spark, path, part, valid, schema)


def newest_day(spark: SparkSession, path: str, part: str, schema: T.StructType | None = None) -> DataFrame:
    """The rows of the newest day. The manifest tells which day that is; files of older days are neither opened nor listed."""
    valid = days(spark, path)
    last = max(valid, default=None)
    return _read_days(spark, path, part, {last: valid[last]} if valid else {}, schema)


def _write_days(df: DataFrame, path: str, part: str, cluster: str, key: str) -> tuple[str, dict[date, int]]:
    """Write `df` into day folders of a new version; (version, rows written for each day), counted in what was written.

    Nothing refers to the folders yet. Rows without a day would land in a folder that no day names, so they
    are counted while the rest is written, and refused before anything refers to it.
    """
    spark, version = df.sparkSession, uuid.uuid4().hex
    laid = _laid_out(df.withColumn(VERSION, F.lit(version)), part, cluster, key)
    laid.write.mode("append").partitionBy(part, VERSION).parquet(_data(path))
    names = files.child_names(spark, _data(path))
    written = [n for n in names if n.startswith(f"{part}=") and files.exists(spark, f"{_data(path)}/{n}/{VERSION}={version}")]
    if not written:
        return version, {}
    folders = [f"{_data(path)}/{n}/{VERSION}={version}" for n in written]
    counted = (
        spark.read.option("basePath", _data(path)).schema(f"{part} string, {VERSION} string").parquet(*folders)
        .groupBy(part).agg(F.count(F.lit(1)).alias("n")).collect()
    )
    rows = {r[0]: r.n for r in counted}
    if None in rows:
        _discard(spark, path, part, written, version)
        raise MissingDayError(f"{rows[None]} row(s) have no {part}")
    return version, {date.fromisoformat(day): n for day, n in rows.items()}


def _discard(spark: SparkSession, path: str, part: str, folders: Iterable[str], version: str) -> None:
    for name in folders:
        files.remove_tree(spark, f"{_data(path)}/{name}/{VERSION}={version}")


def _switch(spark: SparkSession, path: str, base: int | None, rows: list[tuple[date, str, int]]) -> None:
    """Make `rows` the table, unless another load did so since manifest number `base` was read."""
    now = (loads(spark, path) or [None])[-1]
    if now != base:
        raise ConcurrentLoadError(f"manifest {now} came in between; this load was based on {base}")
    tables.write_full(spark.createDataFrame(rows, _MANIFEST).coalesce(1), _manifest(path))


def _state(spark: SparkSession, path: str) -> tuple[int | None, list[tuple[date, str, int]]]:
    kept = loads(spark, path)
    if not kept:
        return None, []
    return kept[-1], [tuple(r) for r in manifest(spark, path, kept[-1]).collect()]


def write_fact(df: DataFrame, path: str, part: str, cluster: str, key: str) -> dict[date, int]:
    """Full load: the table is what `df` holds; returns rows by day. Readers have the old table until the switch."""
    spark = df.sparkSession
    base, _ = _state(spark, path)
    version, rows = _write_days(df, path, part, cluster, key)
    _switch(spark, path, base, [(d, version, n) for d, n in sorted(rows.items())])
    return rows


def overwrite_days(df: DataFrame, path: str, part: str, cluster: str, key: str) -> dict[date, int]:
    """Replace exactly the days present in `df`, all at once; other days keep their folders. Returns rows by day."""
    spark = df.sparkSession
    base, old = _state(spark, path)
    version, rows = _write_days(df, path, part, cluster, key)
    kept = [r for r in old if r[0] not in rows]
    _switch(spark, path, base, sorted([*kept, *((d, version, n) for d, n in rows.items())]))
    return rows


def merge_into_path(
    source: DataFrame, path: str, key: str, part: str, cluster: str, schema: T.StructType | None = None
) -> dict[date, int]:
    """Upsert: update matched keys, insert new ones, keep the rest, all at once; returns rows by rewritten day.

    Keys are matched over the whole target, reading only key and day; then only the days that hold a matched or
    incoming row are read whole and written anew, beside the old ones. A row whose day changed leaves its old
    day, and a day left empty leaves the manifest. A load that stops anywhere leaves the table as it was,
    and running it again gives the same table. `schema` is the stored table's, where the caller knows it.
    A source that repeats a key, or holds a row without a day, is refused before anything is written.
    """
    spark = source.sparkSession
    if unique(source, [key]).limit(1).count():
        raise DuplicateKeyError(f"merge source is not unique on {key}")
    # Calendar days: at most one row per day of history reaches the driver.
    incoming = {r[0] for r in source.select(part).distinct().collect()}
    if None in incoming:
        raise MissingDayError(f"{source.where(F.col(part).isNull()).count()} row(s) have no {part}")
    base, old = _state(spark, path)
    if base is None:
        return write_fact(source, path, part, cluster, key)
    valid = {d: v for d, v, _ in old}
    keys = source.select(key)
    if valid:
        target = _read_days(spark, path, part, valid, schema)
        matched = {r[0] for r in target.select(key, part).join(keys, key, "left_semi").select(part).distinct().collect()}
    else:
        matched = set()
    touched = incoming | matched
    again = {d: v for d, v in valid.items() if d in touched}
    rewritten = source
    if again:
        kept = _read_days(spark, path, part, again, schema).join(keys, key, "left_anti")
        rewritten = union_evolve(kept, source)
    version, rows = _write_days(rewritten, path, part, cluster, key)
    untouched = [r for r in old if r[0] not in touched]
    _switch(spark, path, base, sorted([*untouched, *((d, version, n) for d, n in rows.items())]))
    return rows


def vacuum(spark: SparkSession, path: str, part: str) -> int:
    """Remove day folders that no kept manifest names; returns how many.

    Kept are the newest manifest and the one before it, so readers that began before the last switch still find
    their files. Run it when no load is on its way: folders of an unfinished load are named by no manifest.
    """
    named = {(d, v) for load in loads(spark, path) for d, v in days(spark, path, load).items()}
    gone = 0
    for day in files.child_names(spark, _data(path)):
        if not day.startswith(f"{part}="):
            continue
        for version in files.child_names(spark, f"{_data(path)}/{day}"):
            value = day.removeprefix(f"{part}=")
            known = value[:1].isdigit() and (date.fromisoformat(value), version.removeprefix(f"{VERSION}=")) in named
            if version.startswith(f"{VERSION}=") and not known:
                files.remove_tree(spark, f"{_data(path)}/{day}/{version}")
                gone += 1
        if not files.child_names(spark, f"{_data(path)}/{day}"):
            files.remove_tree(spark, f"{_data(path)}/{day}")
    return gone
