"""Keeping one very large key from becoming one very large task.

A key may own a third of a table. Joins that look something up per row and running
totals per key would send all of its rows to one task. Both helpers below find such keys
from a hash sample of the row identity - about one row in ``chunk_rows``, chosen by value,
so a retried task picks the same rows. The sample only decides where to *cut*: every row
takes part in every result. What it yields is counted before it is broadcast.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Sampled rows a key needs before it counts as hot; below it, one task holds the key.
HOT_SAMPLES = 4
_FEW_CUTS = 64
MOST = 100_000
"""Rows of a table of hot keys or cuts that may be broadcast; a row holds the cuts of one key's day."""
_SCATTER = 1 << 20


def _sampled(identity: list[str], chunk_rows: int) -> Column:
    return F.pmod(F.xxhash64(*identity), F.lit(chunk_rows)) == 0


def hot_keys(rows: DataFrame, key: str, identity: list[str], chunk_rows: int) -> DataFrame:
    """(key, _chunks): keys of at least ``HOT_SAMPLES`` chunks.

    At most rows / (HOT_SAMPLES * chunk_rows) keys are expected, about 60,000 for 10^12 rows
    with the default.
    """
    return (
        rows.where(_sampled(identity, chunk_rows) & F.col(key).isNotNull())
        .groupBy(key)
        # Distinct, so that one identity repeated without end does not ask for endless salts.
        .agg(F.count_distinct(*identity).alias("_chunks"))
        .where(F.col("_chunks") >= HOT_SAMPLES)
    )


def _bounded(small: Callable[[int], DataFrame], chunk_rows: int) -> DataFrame | None:
    """``small(chunk_rows)`` as a table that is surely small enough to broadcast; None if it is empty.

    It is counted while it is brought in. With more than ``MOST`` rows larger chunks are tried: then fewer keys
    are hot and cuts lie further apart, while the results that build on them stay the same.
    """
    while True:
        frame = small(chunk_rows)
        found = frame.limit(MOST + 1).collect()
        if len(found) <= MOST:
            return F.broadcast(frame.sparkSession.createDataFrame(found, frame.schema)) if found else None
        chunk_rows *= 4


def lookup_join(
    rows: DataFrame, per_key: DataFrame, key: str, identity: list[str], chunk_rows: int, how: str = "left"
) -> DataFrame:
    """Join many rows to one row per key; the rows of a hot key are dealt over salts.

    Only hot keys are salted, and only their single ``per_key`` row is repeated, once per salt. Rows without
    a key find nothing, so they may be anywhere: they are dealt by their identity.
    """
    hot = _bounded(lambda chunk: hot_keys(rows, key, identity, chunk), chunk_rows)
    scattered = F.pmod(F.xxhash64(*identity), F.lit(_SCATTER))
    if hot is None:
        dealt = rows.withColumn("_salt", F.when(F.col(key).isNull(), scattered).otherwise(F.lit(0)))
        # Always 0, but computed: a literal would be folded away, and the salt with it.
        repeated = per_key.withColumn("_salt", F.pmod(F.xxhash64(key), F.lit(1)))
    else:
        dealt = rows.join(hot, key, "left").withColumn(
            "_salt",
            F.when(F.col(key).isNull(), scattered)
            .when(F.col("_chunks").isNotNull(), F.pmod(F.xxhash64(*identity), F.col("_chunks"))).otherwise(F.lit(0)),
        ).drop("_chunks")
        repeated = per_key.join(hot, key, "left").withColumn(
            "_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce(F.col("_chunks") - 1, F.lit(0))))
        ).drop("_chunks")
    return dealt.join(repeated, [key, "_salt"], how).drop("_salt")


def _cuts_before(cuts: Column, position: Column) -> Column:
    """How many of the sorted ``cuts`` are at or before ``position``.

    A day has few cuts as a rule, and comparing with each is cheapest. A key concentrated on one
    day can have very many there; those are searched by halving.
    """
    n = F.size(cuts)
    each = F.size(F.filter(cuts, lambda cut: cut <= position))

    def halve(span: Column, _: Column) -> Column:
        lo, hi = span["lo"], span["hi"]
        mid = F.shiftright(lo + hi, 1)
        right = F.get(cuts, mid) <= position
        return F.when(lo >= hi, span).otherwise(
            F.struct(F.when(right, mid + 1).otherwise(lo).alias("lo"), F.when(right, hi).otherwise(mid).alias("hi"))
        )

    steps = F.sequence(F.lit(1), F.ceil(F.log2(n + 1)).cast("int") + 1)
    halved = F.aggregate(steps, F.struct(F.lit(0).alias("lo"), n.alias("hi")), halve)["lo"]
    return F.when(n <= _FEW_CUTS, each).otherwise(halved)


def running_total(
    rows: DataFrame, key: str, order: list[str], value: Column, out: str, chunk_rows: int
) -> DataFrame:
    """Running sum of ``value`` per ``key`` in ``order`` (a timestamp first), exact for any key size; NULL is a key too.

    A prefix sum over ranges of (key, order). Ordinary keys are one range each. A hot key is cut by day, and
    within a day at the sampled rows, so each range holds about ``chunk_rows`` rows; a range's rows are summed in a
    window of its own, and the total of the key's ranges before it is carried in. Cuts follow the sort
    order, hence the sum is the same. Without a hot key it is one window.
    """
    day = F.coalesce(F.to_date(order[0]), F.lit("0001-01-01").cast("date"))
    position = F.struct(*order)
    # Two columns that are never NULL stand for the key, so that NULL joins and spreads like any other.
    named = rows.withColumns({"_value": value, "_null": F.col(key).isNull(), "_key": F.coalesce(F.col(key).cast("string"), F.lit(""))})
    own = ["_null", "_key"]

    def hot_cuts(chunk: int) -> DataFrame:
        days = (
            named.where(_sampled([key, *order], chunk))
            .groupBy(*own, day.alias("_day"))
            # A set: repeated identities must not grow it. Its total size is rows / chunk.
            .agg(F.sort_array(F.collect_set(position)).alias("_cuts"))
        )
        chunks = F.sum(F.size("_cuts")).over(Window.partitionBy(*own))
        return days.withColumn("_chunks", chunks).where(F.col("_chunks") >= HOT_SAMPLES).drop("_chunks")

    cuts = _bounded(hot_cuts, chunk_rows)
    if cuts is None:
        whole = Window.partitionBy(*own).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return named.select(*rows.columns, F.sum("_value").over(whole).alias(out))
    hot = F.broadcast(cuts.select(*own, F.lit(True).alias("_hot")).distinct())
    group = [*own, "_day", "_part"]
    placed = (
        named.join(hot, own, "left")
        .withColumn("_day", F.when(F.col("_hot"), day).otherwise(F.lit("0001-01-01").cast("date")))
        .join(cuts, [*own, "_day"], "left")
        .withColumn("_part", F.when(F.col("_cuts").isNotNull(), _cuts_before(F.col("_cuts"), position)).otherwise(F.lit(0)))
        .drop("_cuts")
    )
    before = Window.partitionBy(*own).orderBy("_day", "_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        placed.where(F.col("_hot")).groupBy(group).agg(F.sum("_value").alias("_total"))
        .withColumn("_before", F.sum("_total").over(before)).drop("_total")
    )  # a row for each range
    inside = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = placed.withColumn("_inside", F.sum("_value").over(inside))
    return (
        summed.join(carried, group, "left")
        .select(*rows.columns, (F.col("_inside") + F.coalesce(F.col("_before"), F.lit(0))).alias(out))
    )
