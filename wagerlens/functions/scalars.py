"""Column helpers shared by the models. All of them stay inside JVM codegen."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wagerlens.schemas import MONEY, RATIO

_DATE_SHAPE = r"^\s*\d{4}-\d{1,2}-\d{1,2}\s*$"
_TS_SHAPE = r"^\s*\d{4}-\d{1,2}-\d{1,2}([ T].*)?$"
_INT_SHAPE = r"^\s*[+-]?\d+\s*$"


def _guarded(text: Column, shape: str, to: str) -> Column:
    # Spark also reads '2024' as a date and '10:00' as a timestamp; the shape keeps those out.
    return F.when(text.rlike(shape), text.try_cast(to))


def safe_date(text: Column) -> Column:
    return _guarded(text, _DATE_SHAPE, "date")


def safe_timestamp(text: Column) -> Column:
    return _guarded(text, _TS_SHAPE, "timestamp")


def safe_long(text: Column) -> Column:
    return _guarded(text, _INT_SHAPE, "bigint")


def safe_money(text: Column) -> Column:
    return text.try_cast(MONEY)


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """Decimal division at nine digits; NULL on a zero or NULL denominator."""
    return F.try_divide(numerator, denominator).cast(RATIO)


def share(part: Column, whole: Column) -> Column:
    """Ratio of two counts as double; NULL when there is nothing to divide by."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def whole_days(start: Column, end: Column) -> Column:
    """Complete 24-hour periods between two timestamps."""
    return F.timestamp_diff("DAY", start, end)


def is_type(kind: str) -> Column:
    return F.col("transaction_type") == kind


def sum_of(kind: str) -> Column:
    """Sum of amounts of one transaction type; 0 where the player has none."""
    return F.sum(F.when(is_type(kind), F.col("amount")).otherwise(F.lit(0).cast(MONEY)))


def signed_amount() -> Column:
    """Wallet view of a movement: deposits add, everything else takes away."""
    return F.when(is_type("deposit"), F.col("amount")).otherwise(-F.col("amount"))


def one_row(*frames: DataFrame) -> DataFrame:
    """Put single-row frames with different columns side by side, without a cross join."""
    stacked = frames[0]
    for frame in frames[1:]:
        stacked = stacked.unionByName(frame, allowMissingColumns=True)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])


def stack_union(frames: list[DataFrame]) -> DataFrame:
    first, *rest = frames
    for frame in rest:
        first = first.unionByName(frame)
    return first
