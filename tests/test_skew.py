"""Hot keys: same numbers as brute force, and no task left holding the whole key."""

from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from wagerlens.operators import skew
from wagerlens.operators.skew import hot_keys, lookup_join, running_total


def _movements(spark, spread: str):
    """5,000 rows; player 'hot' owns most. 'days': many days, 'tied': one instant, 'mixed': both."""
    start = datetime(2024, 1, 1)
    out = []
    for i in range(5000):
        hot = i % 5 != 0
        when = start if spread == "tied" and hot else start + timedelta(days=(i * 7919) % 40, seconds=(i * 31) % 50)
        if spread == "mixed" and hot and i % 2:
            when = start + timedelta(days=3)
        out.append((f"t{(i * 104729) % 100003}", "hot" if hot else f"p{i % 97}", when, (i * 13) % 41 - 20))
    df = spark.createDataFrame(out, "id string, player string, ts timestamp, v bigint")
    return df.withColumn("v", F.col("v").cast("decimal(18,2)"))


@pytest.mark.parametrize("spread", ["days", "tied", "mixed"])
@pytest.mark.parametrize("chunk_rows", [50, 400, 4_000_000])
def test_running_total_is_exact(spark, spread, chunk_rows):
    df = _movements(spark, spread)
    got = running_total(df, "player", ["ts", "id"], F.col("v"), "total", chunk_rows)
    plain = F.sum("v").over(Window.partitionBy("player").orderBy("ts", "id"))
    want = df.withColumn("total", plain)
    assert got.columns == want.columns
    as_set = lambda d: {(r.id, r.total) for r in d.collect()}
    assert got.count() == 5000
    assert as_set(got) == as_set(want)


def test_running_total_keeps_missing_times_first(spark):
    df = spark.createDataFrame(
        [("a", "hot", None, 5)] + [(f"b{i}", "hot", datetime(2024, 1, 1 + i % 9), 1) for i in range(2000)],
        "id string, player string, ts timestamp, v bigint",
    )
    got = running_total(df, "player", ["ts", "id"], F.col("v"), "total", 20)
    assert got.where("id = 'a'").first().total == 5
    assert got.agg(F.max("total")).first()[0] == 2005


def test_hot_keys_are_few_and_right(spark):
    df = _movements(spark, "days")
    assert [r.player for r in hot_keys(df, "player", ["id"], 50).collect()] == ["hot"]
    assert hot_keys(df, "player", ["id"], 4_000_000).count() == 0


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("chunk_rows", [50, 4_000_000])
def test_lookup_join_is_a_join(spark, how, chunk_rows):
    df = _movements(spark, "days").union(spark.createDataFrame([("n1", None, None, None)], "id string, player string, ts timestamp, v decimal(18,2)"))
    facts = spark.createDataFrame([("hot", 1), ("p5", 2), ("nobody", 3)], "player string, fact int")
    got = lookup_join(df, facts, "player", ["id"], chunk_rows, how)
    want = df.join(facts, "player", how)
    key = lambda d: sorted((r.id, r.fact or 0) for r in d.collect())
    assert key(got) == key(want)


def test_lookup_join_deals_a_hot_key_over_tasks(spark):
    df = _movements(spark, "days")
    facts = spark.createDataFrame([("hot", 1)], "player string, fact int")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = lookup_join(df, facts, "player", ["id"], 50, "inner")
        sizes = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
        assert len(sizes) > 1 and max(sizes) < 4000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("chunk_rows", [50, 4_000_000])
def test_rows_without_a_key_have_a_running_total_and_no_task_of_their_own(spark, chunk_rows):
    df = _movements(spark, "mixed").withColumn("player", F.when(F.col("player") != "hot", F.col("player")))
    got = running_total(df, "player", ["ts", "id"], F.col("v"), "total", chunk_rows)
    want = df.withColumn("total", F.sum("v").over(Window.partitionBy("player").orderBy("ts", "id")))
    as_set = lambda d: {(r.id, r.player, r.total) for r in d.collect()}
    assert as_set(got) == as_set(want) and got.count() == 5000
    # an empty text is a key of its own, apart from none
    two = df.withColumn("player", F.when(F.col("player").isNotNull(), F.lit("")))
    again = running_total(two, "player", ["ts", "id"], F.col("v"), "total", chunk_rows)
    assert as_set(again) == as_set(two.withColumn("total", F.sum("v").over(Window.partitionBy("player").orderBy("ts", "id"))))


def test_a_hot_missing_key_is_cut_into_ranges(spark):
    df = _movements(spark, "days").withColumn("player", F.when(F.col("player") != "hot", F.col("player")))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        got = running_total(df, "player", ["ts", "id"], F.col("v"), "total", 50)
        sizes = [r["count"] for r in got.where("player is null").groupBy(F.spark_partition_id().alias("p")).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "2")
    assert max(sizes) < 0.5 * sum(sizes)


@pytest.mark.parametrize("chunk_rows", [50, 4_000_000])
def test_lookup_deals_rows_without_a_key(spark, chunk_rows):
    df = _movements(spark, "days").withColumn("player", F.when(F.col("player") != "hot", F.col("player")))
    facts = spark.createDataFrame([("p5", 2)], "player string, fact int")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        got = lookup_join(df, facts, "player", ["id"], chunk_rows)
        placed = got.withColumn("p", F.spark_partition_id()).collect()
        sizes = Counter(r.p for r in placed if r.player is None).values()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.shuffle.partitions", "2")
    assert sum(sizes) == 4000 and max(sizes) < 800
    assert sum(r.fact == 2 for r in placed) == df.where("player = 'p5'").count()


def test_too_many_cuts_make_larger_chunks_and_the_same_sum(spark, monkeypatch):
    monkeypatch.setattr(skew, "MOST", 10)
    df = _movements(spark, "mixed")
    got = running_total(df, "player", ["ts", "id"], F.col("v"), "total", 20)
    want = df.withColumn("total", F.sum("v").over(Window.partitionBy("player").orderBy("ts", "id")))
    as_set = lambda d: {(r.id, r.total) for r in d.collect()}
    assert as_set(got) == as_set(want)
