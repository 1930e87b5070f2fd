"""Landing: source files to audited raw tables, repeatable without duplicates."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from wagerlens.schemas import AUDIT_COLUMNS, RAW
from wagerlens.sinks.tables import read_full, write_full
from wagerlens.sources.quarantine import ACCEPTED, EXTRA, REASON, RECORD, REJECTED, SHAPE, STATUS, split_source


@dataclass(frozen=True)
class Source:
    """One delivery. ``file`` may also be a folder or a pattern of files of the same kind.

    A CSV with line breaks inside quoted fields is read a file per task; where a source never
    has them, ``quoted_newlines=False`` lets Spark split its files.
    """

    file: str
    table: str
    kind: str  # 'json' (arrays), 'ndjson' or 'csv'
    quoted_newlines: bool = True


# Which file becomes which raw table.
SOURCES = (
    Source("players.json", "players", "json"),
    Source("sessions.json", "sessions", "json"),
    Source("transactions.csv", "transactions", "csv"),
    Source("affiliate_cpa_ftd.csv", "affiliate_cpa_ftd", "csv"),
)


def with_audit(df: DataFrame, ingested_at: datetime) -> DataFrame:
    """Add one load time for all rows, and the name of the file each row came from."""
    return df.withColumns(
        {"_ingested_at": F.lit(ingested_at).cast("timestamp"), "_source_file": F.col("_metadata.file_name")}
    )


@dataclass(frozen=True)
class Landed:
    """What became of one delivery's rows: `read` = `accepted` + `rejected`; `widened` accepted rows had unknown fields."""

    read: int
    accepted: int
    rejected: int
    widened: int


class LandingError(RuntimeError):
    """What is stored does not add up to what was read."""


def _counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("n")), seen


def to_ndjson(df: DataFrame, out: str) -> int:
    """One JSON object per line, LF, UTF-8, NULL fields kept; returns the number of rows written."""
    counted, seen = _counted(df)
    counted.write.mode("overwrite").option("ignoreNullFields", "false").json(out)
    return seen.get["n"]


def land_full(df: DataFrame, path: str) -> int:
    """Replace a raw table; readers see the old snapshot until the new one is complete."""
    counted, seen = _counted(df)
    write_full(counted, path)
    return seen.get["n"]


def split_delivery(spark: SparkSession, folder: str, source: Source, ingested_at: datetime) -> DataFrame:
    """All rows of a delivery, accepted and rejected, with one load time for all."""
    split = split_source(spark, f"{folder}/{source.file}", source.kind, RAW[source.table], source.quoted_newlines)
    return split.withColumn("_ingested_at", F.lit(ingested_at).cast("timestamp"))


def land_source(spark: SparkSession, folder: str, path: str, source: Source, ingested_at: datetime) -> Landed:
    """Replace a raw table by a delivery, rejected rows included, in one read and one switch.

    The rows counted while they were read are held against those that can be read back, so a delivery that did not
    arrive whole is noticed before anything is built on it.
    """
    split = split_delivery(spark, folder, source, ingested_at)
    seen = Observation()
    ok = F.col(STATUS) == ACCEPTED
    split = split.observe(
        seen, F.count(F.lit(1)).alias("read"), F.count_if(ok).alias("accepted"), F.count_if(ok & F.col(EXTRA).isNotNull()).alias("widened")
    )
    write_full(split, path, STATUS)
    found = seen.get
    landed = Landed(found["read"], found["accepted"], found["read"] - found["accepted"], found["widened"])
    stored = {r[0]: r[1] for r in whole(spark, path).groupBy(STATUS).count().collect()}
    if stored.get(ACCEPTED, 0) != landed.accepted or stored.get(REJECTED, 0) != landed.rejected:
        raise LandingError(f"{source.table}: read {landed}, stored {stored}")
    return landed


def _stored(table: str) -> str:
    names = ", ".join(f"`{n}` string" for n in RAW[table].names)
    own = f"{EXTRA} map<string,string>, {SHAPE} string, {REASON} string, {RECORD} string, _source_file string, _delivered_at timestamp, _ingested_at timestamp"
    return f"{names}, {own}, {STATUS} string"


def whole(spark: SparkSession, path: str) -> DataFrame:
    """Accepted and rejected rows as landed; the table's name is the path's last part."""
    return read_full(spark, path, schema=_stored(path.rstrip("/").rsplit("/", 1)[-1]))


def accepted(spark: SparkSession, path: str) -> DataFrame:
    """The contract's columns, the audit columns and the delivery time of the accepted rows; rejected files stay unopened."""
    rows = whole(spark, path).where(F.col(STATUS) == ACCEPTED)
    return rows.select(*RAW[path.rstrip("/").rsplit("/", 1)[-1]].names, *AUDIT_COLUMNS, "_delivered_at")


def rejected(spark: SparkSession, path: str) -> DataFrame:
    """(record, reason) of the rejected rows, with the audit columns; accepted files stay unopened."""
    rows = whole(spark, path).where(F.col(STATUS) == REJECTED)
    return rows.select(F.col(RECORD).alias("record"), F.col(REASON).alias("reason"), *AUDIT_COLUMNS, "_delivered_at")


def widened(spark: SparkSession, path: str) -> DataFrame:
    """Accepted rows with fields that the contract does not know, those in `extra`."""
    rows = whole(spark, path).where((F.col(STATUS) == ACCEPTED) & F.col(EXTRA).isNotNull())
    return rows.select(*RAW[path.rstrip("/").rsplit("/", 1)[-1]].names, F.col(EXTRA).alias("extra"), *AUDIT_COLUMNS)


def land_all(
    spark: SparkSession, src_dir: str, out_dir: str, ingested_at: datetime, convert_only: bool = False,
    sources: Sequence[Source] = SOURCES,
) -> dict[str, Landed]:
    """Land every source; returns what became of its rows, by table.

    `convert_only` stops after NDJSON files: accepted rows with their audit columns, and rejected ones in a
    folder of their own.
    """
    out = {}
    for source in sources:
        path = f"{out_dir}/{'staged' if convert_only else 'raw'}/{source.table}"
        out[source.table] = land_source(spark, src_dir, path, source, ingested_at)
        if convert_only:
            to_ndjson(accepted(spark, path).drop("_delivered_at"), f"{out_dir}/ndjson/{source.table}")
            to_ndjson(rejected(spark, path).drop("_delivered_at"), f"{out_dir}/ndjson_rejected/{source.table}")
    return out
