"""Sketched profiles against exact ones, within the bounds they state, and merged ones against whole ones."""

from pyspark.sql import functions as F

from tests.conftest import rows
from wagerlens.operators.discovery import column_profile
from wagerlens.operators.sketches import column_sketches, merge_sketches, sketched_profile


def _numbers(spark, n):
    i = F.col("id")
    return spark.range(n).select(
        F.concat(F.lit("k"), i).alias("key"), F.when(i % 10 > 0, (i * 7919 % n).cast("double") / 4).alias("amount"),
        F.when(i % 3 == 0, "hot").when(i % 7 == 0, "warm").otherwise(F.concat(F.lit("v"), i % 5000)).alias("kind"),
        F.date_add(F.lit("2024-01-01").cast("date"), (i % 30).cast("int")).alias("day"),
    )


def _by_name(profile):
    return {r.column_name: r for r in profile.collect()}


def test_estimates_keep_their_bounds(spark):
    n = 120_000
    df = _numbers(spark, n).repartition(7)
    got, exact = _by_name(sketched_profile(column_sketches(df), (0.01, 0.5, 0.99))), _by_name(column_profile(df))
    for name, want in exact.items():
        r = got[name]
        assert (r.data_type, r.n_rows, r.n_nulls, r.min_value, r.max_value) == (
            want.data_type, want.n_rows, want.n_nulls, want.min_value, want.max_value)
        assert abs(r.n_distinct / want.n_distinct - 1) < 0.025, name
    assert (got["day"].n_distinct, got["kind"].n_distinct) == (30, exact["kind"].n_distinct)  # few enough to be exact
    assert abs(got["amount"].mean_value / exact["amount"].mean_value - 1) < 1e-9
    for q, value in zip((0.01, 0.5, 0.99), got["amount"].quantiles):
        rank = df.where(F.col("amount") <= value).count() / (n * 0.9)
        assert abs(rank - q) < 0.008
    assert got["key"].quantiles is None
    first = got["kind"].common[0]
    assert first.value == "hot" and abs(first.n - n / 3) < n / 700 and got["kind"].common[1].value == "warm"


def test_profiles_of_parts_add_up(spark, tmp_path):
    df = _numbers(spark, 30_000)
    for part in range(4):  # as a load a day would leave them
        column_sketches(df.where(F.pmod(F.xxhash64("key"), F.lit(4)) == part)).write.mode("append").parquet(str(tmp_path))
    merged = _by_name(sketched_profile(merge_sketches(spark.read.parquet(str(tmp_path)))))
    whole = _by_name(sketched_profile(column_sketches(df)))
    for name, want in whole.items():
        r = merged[name]
        assert (r.n_rows, r.n_nulls, r.min_value, r.max_value) == (want.n_rows, want.n_nulls, want.min_value, want.max_value)
        assert abs(r.n_distinct / want.n_distinct - 1) < 0.025
    assert [c.value for c in merged["kind"].common[:2]] == ["hot", "warm"]


def test_no_values_of_a_column_cross_the_network(spark):
    plan = column_sketches(_numbers(spark, 1000))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "SinglePartition" in plan  # the tasks' sketches, a row each


def test_empty_and_missing_columns(frame):
    df = frame("a string, n bigint", (None, None), (None, None))
    for table, n in ((df, 2), (df.limit(0), 0)):
        got = _by_name(sketched_profile(column_sketches(table)))
        assert [(got[c].n_rows, got[c].n_nulls, got[c].n_distinct, got[c].mean_value, got[c].quantiles) for c in "an"] == [(n, n, 0, None, None)] * 2
    assert rows(sketched_profile(column_sketches(df, ["n"])), "column_name", "n_rows") == [("n", 2)]
