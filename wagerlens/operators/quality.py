"""Generic data-quality checks. A check takes a DataFrame and returns what fails it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wagerlens.functions.scalars import stack_union


def unique(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Keys held by more than one row; rows with a NULL in the key are not compared."""
    present = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols])
    return df.where(present).groupBy(*cols).agg(F.count("*").alias("n_records")).where("n_records > 1")


def not_null(df: DataFrame, col: str) -> DataFrame:
    return df.where(F.col(col).isNull())


def accepted_values(df: DataFrame, col: str, values: Sequence[Any]) -> DataFrame:
    """Values outside the list with their row counts; NULL passes."""
    return (
        df.where(F.col(col).isNotNull() & ~F.col(col).isin(list(values)))
        .groupBy(F.col(col).alias("value")).agg(F.count("*").alias("n_records"))
    )


def relationships(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Foreign keys without a parent, with their row counts; NULL passes.

    Child rows are counted per key before the join, so one key with very many rows is one row.
    """
    keys = child.where(F.col(fk).isNotNull()).groupBy(F.col(fk).alias("value")).agg(F.count("*").alias("n_records"))
    return keys.join(parent.select(F.col(pk).alias("value")), "value", "left_anti")


def between(df: DataFrame, col: str, lo: Any = None, hi: Any = None) -> DataFrame:
    """Rows outside [lo, hi]; either bound may be left out; NULL passes."""
    bad = F.lit(False)
    if lo is not None:
        bad = bad | (F.col(col) < F.lit(lo))
    if hi is not None:
        bad = bad | (F.col(col) > F.lit(hi))
    return df.where(bad)


class ContractError(ValueError):
    """A frame does not have the promised columns and types."""


def enforce_contract(df: DataFrame, contract: T.StructType) -> DataFrame:
    """Fail on a missing, additional or retyped column; otherwise return columns in contract order."""
    have = {f.name: f.dataType for f in df.schema.fields}
    want = {f.name: f.dataType for f in contract.fields}
    problems = [f"missing {c}" for c in want if c not in have]
    problems += [f"unexpected {c}" for c in have if c not in want]
    problems += [
        f"{c}: {have[c].simpleString()} instead of {want[c].simpleString()}"
        for c in want if c in have and have[c] != want[c]
    ]
    if problems:
        raise ContractError("; ".join(problems))
    return df.to(contract)


def freshness(sources: Mapping[str, tuple[DataFrame, str, timedelta, timedelta]], as_of: datetime) -> DataFrame:
    """Per source: age of its newest row at ``as_of`` against (warn, error) limits."""

    def one(name: str, df: DataFrame, ts: str, warn: timedelta, error: timedelta) -> DataFrame:
        newest = F.col("max_loaded_at")
        now = F.lit(as_of).cast("timestamp")
        return (
            df.agg(F.max(ts).alias("max_loaded_at"))
            .withColumn("source", F.lit(name))
            .withColumn("age_seconds", F.timestamp_diff("SECOND", newest, now))
            .withColumn(
                "status",
                F.when(newest.isNull() | (newest < now - F.lit(error)), "error")
                .when(newest < now - F.lit(warn), "warn").otherwise("pass"),
            )
            .select("source", "max_loaded_at", "age_seconds", "status")
        )

    return stack_union([one(name, *spec) for name, spec in sources.items()])


def schema_frame(spark: SparkSession, df: DataFrame) -> DataFrame:
    """(column_name, data_type) of a frame, to be stored as the drift baseline."""
    return spark.createDataFrame(df.dtypes, "column_name string, data_type string")


def schema_changes(current: DataFrame, baseline: DataFrame) -> DataFrame:
    """Columns added, removed or retyped, between two frames made by ``schema_frame``."""
    now, then = current.withColumnRenamed("data_type", "now"), baseline.withColumnRenamed("data_type", "then")
    change = (
        F.when(F.col("then").isNull(), "added").when(F.col("now").isNull(), "removed")
        .when(F.col("now") != F.col("then"), "type_changed")
    )
    return (
        now.join(then, "column_name", "full").withColumn("change", change).where("change is not null")
        .select("column_name", "change", F.col("then").alias("old_type"), F.col("now").alias("new_type"))
    )


def volume_anomaly(df: DataFrame, ts_col: str, train: int = 14, z: float = 3.0) -> DataFrame:
    """Days whose row count lies more than ``z`` deviations from the mean of the ``train`` days before.

    Days without rows count as zero. Only the daily counts, one row per calendar day, meet in
    the final window; the first ``train`` days have no verdict, nor have flat histories.
    """
    counts = df.where(F.col(ts_col).isNotNull()).groupBy(F.to_date(ts_col).alias("day")).agg(F.count("*").alias("n_rows"))
    spine = counts.agg(F.min("day").alias("a"), F.max("day").alias("b")).where("a is not null").select(
        F.explode(F.sequence("a", "b", F.expr("interval 1 day"))).alias("day")
    )
    daily = spine.join(counts, "day", "left").withColumn("n_rows", F.coalesce("n_rows", F.lit(0)))
    before = Window.orderBy("day").rowsBetween(-train, -1)
    scored = daily.select(
        "day", "n_rows",
        F.count("*").over(before).alias("history"),
        F.avg("n_rows").over(before).alias("mean_rows"),
        F.stddev_samp("n_rows").over(before).alias("sd_rows"),
    ).withColumn("z_score", F.try_divide(F.col("n_rows") - F.col("mean_rows"), F.col("sd_rows")))
    return scored.where((F.col("history") >= train) & (F.abs("z_score") > z)).drop("history")


def delivery_anomaly(history: DataFrame, train: int = 14, z: float = 3.0, least: int = 3, floor: float = 0.05) -> DataFrame:
    """Runs whose row count of a source lies more than ``z`` spreads from the mean of its ``train`` runs before.

    ``history`` has run_id, run_at, source, n_rows: one row per source and run. The spread is the deviation of those
    runs, and at least ``floor`` of their mean, so a source that always delivers alike has a verdict too. The first
    ``least`` runs of a source have none. Only runs meet in a window, never rows of a source.
    """
    before = Window.partitionBy("source").orderBy("run_at", "run_id").rowsBetween(-train, -1)
    scored = history.select(
        "run_id", "run_at", "source", "n_rows",
        F.count("*").over(before).alias("history"),
        F.avg("n_rows").over(before).alias("mean_rows"),
        F.coalesce(F.stddev_samp("n_rows").over(before), F.lit(0.0)).alias("sd_rows"),
    )
    spread = F.greatest(F.col("sd_rows"), F.lit(floor) * F.col("mean_rows"))
    apart = F.col("n_rows") - F.col("mean_rows")
    # a source that was always empty has no spread: any row is news
    fires = F.when(spread == 0, apart != 0).otherwise(F.abs(apart) > F.lit(z) * spread)
    return scored.where((F.col("history") >= least) & fires).withColumn("z_score", F.try_divide(apart, spread)).drop("history")


@dataclass(frozen=True)
class Check:
    """A check that has to build its own frame of failing rows, such as a key or a reference."""

    name: str
    severity: str  # 'error' or 'warn'
    failing: DataFrame


@dataclass(frozen=True)
class RowCheck:
    """A check decided row by row: ``fails`` is true for failing rows of ``df``."""

    name: str
    severity: str
    df: DataFrame
    fails: Column


class QualityError(RuntimeError):
    """At least one check of severity 'error' found failing rows."""


def _result_line(check: Check | RowCheck, failures: Column) -> list[Column]:
    level = "error" if check.severity == "error" else "warn"
    return [
        F.lit(check.name).alias("check_name"),
        F.lit(check.severity).alias("severity"),
        failures.alias("failures"),
        F.when(failures == 0, "pass").otherwise(level).alias("status"),
    ]


def run_suite(checks: Sequence[Check | RowCheck]) -> DataFrame:
    """(check_name, severity, failures, status): every check counted in one Spark job.

    All row checks of one frame share a single scan of it, whatever their number.
    """
    counted = []
    by_frame: dict[int, list[RowCheck]] = {}
    for check in checks:
        if isinstance(check, RowCheck):
            by_frame.setdefault(id(check.df), []).append(check)
        else:
            found = check.failing.agg(F.count("*").alias("failures"))
            counted.append(found.select(*_result_line(check, F.col("failures"))))
    for group in by_frame.values():
        sums = group[0].df.agg(*[F.count_if(c.fails).alias(f"c{i}") for i, c in enumerate(group)])
        lines = F.array(*[F.struct(*_result_line(c, F.col(f"c{i}"))) for i, c in enumerate(group)])
        counted.append(sums.select(F.inline(lines)))
    return stack_union(counted)


def raise_on_error(results: DataFrame) -> None:
    """Fail the run on an error-level finding; warnings only report. One row per check is read."""
    broken = results.where("status = 'error'").collect()
    if broken:
        raise QualityError("; ".join(f"{r.check_name}: {r.failures} failing rows" for r in broken))


def log_results(results: DataFrame, path: str, run_id: str, run_at: datetime) -> None:
    """Append a run's results to the history table."""
    stamped = results.withColumn("run_id", F.lit(run_id)).withColumn("run_at", F.lit(run_at).cast("timestamp"))
    stamped.coalesce(1).write.mode("append").parquet(path)


def pass_rates(rules: Mapping[str, tuple[DataFrame, Column]]) -> DataFrame:
    """(rule, pass_rate): share of rows of each frame that satisfy its condition."""
    return stack_union(
        [
            df.agg(F.avg(ok.cast("double")).alias("pass_rate")).select(F.lit(rule).alias("rule"), "pass_rate")
            for rule, (df, ok) in rules.items()
        ]
    )


def slo_pass_rates(
    players: DataFrame, transactions: DataFrame, sessions: DataFrame, affiliate: DataFrame, movements: DataFrame
) -> DataFrame:
    """(rule, pass_rate) of the service levels. Referential integrity is 1 if every row has its player, else 0."""

    def linked(child: DataFrame) -> DataFrame:
        counts = child.groupBy("player_id").agg(F.count("*").alias("n"))
        seen = counts.join(players.select("player_id", F.lit(True).alias("known")), "player_id", "left")
        return seen.agg(F.coalesce(F.sum(F.when(F.col("known").isNull(), F.col("n"))), F.lit(0)).alias("orphans"))

    links = linked(transactions).union(linked(sessions)).agg(F.sum("orphans").alias("orphans"))
    # Movements per player and day meet the registration day: same verdict as row by row.
    days = movements.groupBy("player_id", "txn_date").agg(F.count("*").alias("n"))
    timed = days.join(players.select("player_id", "created_at"), "player_id").agg(
        F.try_divide(
            F.sum(F.when(F.col("txn_date") >= F.col("created_at"), F.col("n")).otherwise(0)).cast("double"),
            F.sum("n").cast("double"),
        ).alias("pass_rate")
    ).select(F.lit("no transaction before created_at").alias("rule"), "pass_rate")
    return pass_rates({
        "referential integrity": (links, F.col("orphans") == 0),
        "amount > 0": (transactions, F.col("amount") > 0),
        "ftd <= registrations": (affiliate, F.col("ftd") <= F.col("registrations")),
    }).union(timed)
