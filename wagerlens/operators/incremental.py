"""Incremental load strategies as plain relations: window, merge, partition replace, evolve."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def incremental_window(
    source: DataFrame, target: DataFrame, source_ts: str, target_ts: str, days: int = 3
) -> DataFrame:
    """Source rows at or after the target's newest value less ``days``; late data is re-read.

    Compares in the type of the target column: a timestamp column goes back whole days from
    the instant, a date column from the day. An empty target selects nothing - a first load
    does not go through here.
    """
    newest = F.max(target_ts)
    if dict(target.dtypes)[target_ts] == "date":
        floor, value = F.date_sub(newest, days), F.to_date(source_ts)
    else:
        floor, value = newest - F.expr(f"interval {days} days"), F.col(source_ts)
    return source.where(value >= target.select(floor).scalar())


def union_evolve(target: DataFrame, source: DataFrame) -> DataFrame:
    """Append rows; columns only one side has are NULL on the other."""
    return target.unionByName(source, allowMissingColumns=True)


def merge_upsert(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Update matched rows, insert new ones, keep the rest. ``source`` is unique on ``key``."""
    return union_evolve(target.join(source.select(key), key, "left_anti"), source)


def overwrite_partitions(target: DataFrame, source: DataFrame, part: str) -> DataFrame:
    """Replace exactly the partitions present in ``source``.

    The partition values of a batch are calendar days, so they are few whatever the batch
    holds; broadcasting them keeps the target from being shuffled by day.
    """
    days = F.broadcast(source.select(part).distinct())
    return union_evolve(target.join(days, part, "left_anti"), source)
