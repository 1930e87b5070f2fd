"""Full-refresh tables on Parquet paths: a snapshot at a time, the newest complete one is the table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wagerlens.sinks import files

_PREFIX = "snap-"
_KEEP = 2


def _snapshots(spark: SparkSession, path: str) -> list[str]:
    return [n for n in files.child_names(spark, path) if n.startswith(_PREFIX)]


def _complete(spark: SparkSession, path: str) -> list[str]:
    # Spark writes _SUCCESS last, when all task output is committed.
    return [n for n in _snapshots(spark, path) if files.exists(spark, f"{path}/{n}/_SUCCESS")]


def write_full(df: DataFrame, path: str, *parts: str) -> None:
    """Replace a table by writing a new snapshot beside the current one, in folders by `parts` if there are any.

    A reader finds the newest complete snapshot, so a failed or repeated load never shows half a
    table, and a table may be rebuilt from itself. The snapshot before is kept for readers still
    on it; older and incomplete ones go.
    """
    spark = df.sparkSession
    taken = _snapshots(spark, path)
    number = int(taken[-1].removeprefix(_PREFIX)) + 1 if taken else 1
    df.write.mode("errorifexists").partitionBy(*parts).parquet(f"{path}/{_PREFIX}{number:08d}")
    keep = set(_complete(spark, path)[-_KEEP:])
    for name in taken:
        if name not in keep:
            files.remove_tree(spark, f"{path}/{name}")


def snapshot_numbers(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the complete snapshots, oldest first; none where there is no table."""
    return [int(n.removeprefix(_PREFIX)) for n in _complete(spark, path)]


def read_full(spark: SparkSession, path: str, number: int | None = None, schema: str | None = None) -> DataFrame:
    """The newest complete snapshot, or the one numbered `number`; with a known schema no file is opened to find out."""
    complete = _complete(spark, path)
    wanted = complete[-1] if complete and number is None else f"{_PREFIX}{number or 0:08d}"
    if wanted not in complete:
        raise FileNotFoundError(f"no complete snapshot {'' if number is None else number} under {path}")
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(f"{path}/{wanted}")
