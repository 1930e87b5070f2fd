"""Allow and block rules on urls: a sort-merge range join of canonical keys with nested rules."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wagerlens.llm.common import materialize, partitions

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_host(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; empty without `://` or for null."""
    return F.translate(F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0), _UPPER, _LOWER)


def url_path(url: Column) -> Column:
    """After the host up to `?`, `#` or the end; empty without `://` or for null."""
    return F.regexp_extract(F.regexp_replace(_after_scheme(url), r"^[^/?#]*", ""), r"^[^?#]*", 0)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + F.lit(3))).otherwise(F.lit(""))


def rule_table(spark: SparkSession, rules: Iterable[tuple[str, str]]) -> DataFrame:
    """("allow" or "block", "host/path") pairs as the table that `judge_urls` takes."""
    return spark.createDataFrame(list(rules), "verdict string, rule string")


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """One row per row of `pages`: page_id, host, path, rule, verdict.

    `rules` has verdict and rule (`host/path`; what follows the first slash, slash included, is the path).
    A rule fits its host and all subdomains if the url's path starts with its path; the longest rule wins,
    of equally long ones that with the longer host. Where no rule fits, rule is null and verdict is `default`.

    The host's labels are reversed, so that a rule covers an interval of keys: everything that starts with
    `org.example//es/`. A url asks once for each domain above it (`org//es/1`, `org.example//es/1`, ...).
    Rules and questions are range-partitioned and sorted together. Each rule carries the stack of rules that
    enclose it; sweeping in order, the last rule passed holds on its stack every rule that is still open at
    the question. A partition starts with the stack that the ones before it left, so no range depends on
    another's rows, and equal urls are asked for once, however often they occur.

    Null urls, and those without `://`, have an empty host and path. Rules given twice count once; if they
    disagree, block wins. Repeated pages give repeated rows; no pages, no rows; other columns are ignored.
    """
    spark = pages.sparkSession
    asked = pages.select("page_id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    events = materialize(_swept(_questions(asked), _stacks(rules), partitions(spark)), "events")
    best = _open_rules(events).groupBy("host", "path").agg(F.max("found").alias("found"))
    return asked.join(best, ["host", "path"], "left").select(
        "page_id", "host", "path", F.col("found.rule").alias("rule"),
        F.coalesce("found.verdict", F.lit(default)).alias("verdict"),
    )


def _key(host: Column, path: Column) -> Column:
    return F.concat(host, F.lit("/"), path)


def _reversed(host: Column) -> Column:
    return F.reverse(F.split(host, r"\."))


def _questions(asked: DataFrame) -> DataFrame:
    """Each distinct (host, path), once for every domain that holds it."""
    labels = _reversed(F.col("host"))
    depth = F.explode(F.sequence(F.lit(1), F.size(labels))).alias("depth")
    return (
        asked.where("host <> ''").select("host", "path").distinct().select("host", "path", depth)
        .select("host", "path", _key(F.array_join(F.slice(labels, F.lit(1), F.col("depth")), "."), F.col("path")).alias("key"))
    )


def _stacks(rules: DataFrame) -> DataFrame:
    """(key, stack): a rule's key and all rules whose interval encloses it, itself included."""
    rule = F.regexp_extract(F.col("rule"), r"^[^/]*", 0)
    host = F.translate(rule, _UPPER, _LOWER)
    path = F.substr(F.col("rule"), F.length(rule) + F.lit(1))
    each = (
        rules.where("rule is not null").select("verdict", host.alias("host"), path.alias("path"))
        .where("host <> ''").groupBy("host", "path").agg(F.max("verdict").alias("verdict"))  # block > allow
        .select(
            _key(F.array_join(_reversed(F.col("host")), "."), F.col("path")).alias("key"), "path",
            F.struct(
                (F.length("host") + F.length("path")).alias("length"), F.length("host").alias("host_length"),
                F.concat("host", "path").alias("rule"), "verdict",
            ).alias("found"),
        )
    )
    # what a rule's key starts with, back to its bare host: only those can enclose it
    starts = F.explode(F.sequence(F.length("key") - F.length("path"), F.length("key")))
    inner = each.select("key", starts.alias("n")).select("key", F.substring("key", F.lit(1), F.col("n")).alias("outer"))
    outer = each.select(F.col("key").alias("outer"), "found")
    stack = F.collect_list(F.struct(F.col("outer").alias("prefix"), "found")).alias("stack")
    return inner.join(outer, "outer").groupBy("key").agg(stack)


def _swept(questions: DataFrame, rules: DataFrame, pieces: int) -> DataFrame:
    """Rules and questions in ranges of the key; `piece` numbers the ranges in order."""
    both = rules.select("key", F.lit(0).alias("kind"), "stack", F.lit("").alias("host"), F.lit("").alias("path")).unionByName(
        questions.select("key", F.lit(1).alias("kind"), F.lit(None).cast(rules.schema["stack"].dataType).alias("stack"), "host", "path")
    )
    return both.repartitionByRange(pieces, "key", "kind", "host", "path").withColumn("piece", F.spark_partition_id())


def _open_rules(events: DataFrame) -> DataFrame:
    """(host, path, found): the longest rule of each question's domain that is open there."""
    left = events.where("kind = 0").groupBy("piece").agg(F.max_by("stack", "key").alias("left"))
    pieces = events.select("piece").distinct().join(left, "piece", "left")
    earlier = Window.orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    carried = pieces.select("piece", F.last("left", ignorenulls=True).over(earlier).alias("carried"))  # a row for each range
    sweep = Window.partitionBy("piece").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    passed = events.withColumn("stack", F.last("stack", ignorenulls=True).over(sweep)).where("kind = 1")
    at = passed.join(F.broadcast(carried), "piece").select(
        "host", "path", F.filter(F.coalesce("stack", "carried"), lambda r: F.startswith(F.col("key"), r.prefix)).alias("open")
    )
    return at.where("size(open) > 0").select("host", "path", F.array_max(F.transform("open", lambda r: r.found)).alias("found"))
