"""What the sources looked like over time: a registry of their fields, and a history of their volumes.

Both are append-only Parquet tables beside the output; each load adds rows and changes none.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wagerlens.operators.quality import schema_changes
from wagerlens.sinks import files
from wagerlens.sources.landing import Landed

_VERSIONS = "source string, version int, run_id string, run_at timestamp, column_name string, data_type string"
_APPROVALS = "source string, version int, approved_at timestamp"
_VOLUMES = "run_id string, run_at timestamp, source string, n_read bigint, n_rows bigint, n_rejected bigint, n_widened bigint"


def _table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(path) if files.exists(spark, path) else spark.createDataFrame([], schema)


def _append(spark: SparkSession, rows: list[tuple], path: str, schema: str) -> None:
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)


# schemas


def versions(spark: SparkSession, path: str, source: str) -> DataFrame:
    """Every registered version of a source's fields."""
    return _table(spark, f"{path}/versions", _VERSIONS).where(F.col("source") == source)


def approve(spark: SparkSession, path: str, source: str, version: int, at: datetime) -> None:
    """From now on deliveries are held against this version."""
    _append(spark, [(source, version, at)], f"{path}/approvals", _APPROVALS)


def _last_approved(spark: SparkSession, path: str, source: str) -> int | None:
    rows = _table(spark, f"{path}/approvals", _APPROVALS).where(F.col("source") == source)
    found = rows.agg(F.max_by("version", F.struct("approved_at", "version")).alias("version")).first()
    return found.version


def drift(observed: DataFrame, baseline: DataFrame) -> DataFrame:
    """Fields added, removed or retyped against `baseline`; a field without any value has no kind to compare."""
    then = baseline.select("column_name", F.col("data_type").alias("then"))
    known = observed.select("column_name", "data_type").join(then, "column_name", "left")
    unknown = (F.col("data_type") == "") | (F.col("then") == "")
    now = known.select("column_name", F.when(unknown, F.col("then")).otherwise(F.col("data_type")).alias("data_type"))
    return schema_changes(now, baseline)


def register(spark: SparkSession, path: str, source: str, observed: DataFrame, contract: T.StructType, run_id: str, at: datetime) -> DataFrame:
    """Add the delivery's fields as a new version where they differ from the newest one; returns the drift to report.

    A delivery is held against the version approved last, or, before any is, against the contract's names of any kind.
    The first version that shows no drift is approved by itself; later ones are held against it until somebody
    approves another, so a change is reported by every run, not only by the first that meets it. A delivery without a
    row shows no fields, and so no drift: that it is empty is the volume's concern.
    """
    named = "column_name string, data_type string"
    # A source has as many fields as its contract, and those its deliveries add.
    fields = sorted((r.column_name, r.data_type) for r in observed.select("column_name", "data_type").collect())
    known: dict[int, set[tuple[str, str]]] = {}
    for r in versions(spark, path, source).collect():
        known.setdefault(r.version, set()).add((r.column_name, r.data_type))
    approved = _last_approved(spark, path, source)
    expected = sorted(known[approved]) if approved is not None else [(n, "") for n in contract.names]
    changes = drift(spark.createDataFrame(fields, named), spark.createDataFrame(expected, named))
    if not fields:
        return changes.limit(0)
    version = max(known, default=0)
    if known.get(version) != set(fields):
        version += 1
        _append(spark, [(source, version, run_id, at, name, kind) for name, kind in fields], f"{path}/versions", _VERSIONS)
    if approved is None and changes.isEmpty():
        approve(spark, path, source, version, at)
    return changes


# volumes


def record_volumes(spark: SparkSession, path: str, run_id: str, at: datetime, landed: Mapping[str, Landed]) -> None:
    """Add a run's counts to the history, a row for each source."""
    _append(spark, [(run_id, at, name, n.read, n.accepted, n.rejected, n.widened) for name, n in sorted(landed.items())], path, _VOLUMES)


def volumes(spark: SparkSession, path: str) -> DataFrame:
    return _table(spark, path, _VOLUMES)
