"""One read of a delivery that keeps everything: rows that fit the contract's columns, and rejected ones with their reason.

Both parts are one table, split by `_status`, so they come from the same load and change together. What a
delivery has beyond the contract's columns stays with its row in `_extra`, and `_shape` tells which fields a record had
and of what kind, which is what the schema registry reads.
"""

from __future__ import annotations

import csv
from collections import Counter
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wagerlens.sources.readers import CORRUPT
from wagerlens.sources.records import FILE, json_records, json_line_records, lines_of

ACCEPTED, REJECTED = "accepted", "rejected"
EXTRA, SHAPE, STATUS, REASON, RECORD = "_extra", "_shape", "_status", "_reason", "_record"
_NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def _kind(variant: Column) -> Column:
    """text, number, boolean, object, array or null."""
    kind = F.schema_of_variant(variant)
    return (
        F.when(variant.isNull() | (kind == "VOID"), "null").when(kind == "STRING", "text").when(kind == "BOOLEAN", "boolean")
        .when(kind.startswith("OBJECT"), "object").when(kind.startswith("ARRAY"), "array").otherwise("number")
    )


def split_json(records: DataFrame, schema: T.StructType) -> DataFrame:
    """Records (from `records`) as the contract's text columns, `_extra`, `_shape`, `_status`, `_reason`, `_record` and the file.

    Rejected: text that is no JSON object. A field that is missing is NULL; one that the contract does not know
    goes into `_extra` as JSON text.
    """
    names = schema.names
    fields = F.from_json("record", "map<string,variant>")
    parsed = records.withColumns({"_fields": F.when(~F.col("outside"), fields), "_values": F.from_json("record", schema.simpleString())})
    broken = F.col("_fields").isNull()
    reason = F.when(F.col("outside"), "outside of a record").when(broken, "not a JSON object")
    beyond = F.map_filter("_fields", lambda k, v: ~k.isin(*names))
    extra = F.when(F.size(beyond) > 0, F.transform_values(beyond, lambda k, v: F.to_json(v)))
    shape = F.array_sort(F.transform(F.map_entries("_fields"), lambda e: F.concat(e.key, F.lit("="), _kind(e.value))))
    return _split(parsed, {n: F.col(f"_values.`{n}`") for n in names}, reason, extra, F.array_join(shape, "\x1f"))


def _split(df: DataFrame, values: dict[str, Column], reason: Column, extra: Column, shape: Column) -> DataFrame:
    bad = reason.isNotNull()
    return df.select(
        *[F.when(~bad, value).alias(name) for name, value in values.items()],
        F.when(~bad, extra).alias(EXTRA), F.when(~bad, shape).alias(SHAPE), F.when(bad, REJECTED).otherwise(ACCEPTED).alias(STATUS),
        reason.alias(REASON), F.when(bad, F.col("record")).alias(RECORD), *FILE,
    )


def csv_headers(spark: SparkSession, path: str | Sequence[str], delimiter: str = ",") -> dict[tuple[str, ...], list[str]]:
    """Header -> files that have it. Files without a line are left out.

    Each file's first line is found where the file lies; the files' names reach the driver, as they do in any read.
    """
    first = lines_of(spark, path).groupBy("path").agg(F.min_by("value", F.struct("block", "row")).alias("header"))
    out: dict[tuple[str, ...], list[str]] = {}
    for row in first.orderBy("path").collect():
        names = next(csv.reader([row.header.rstrip("\r").removeprefix("\ufeff")], delimiter=delimiter), ())
        out.setdefault(tuple(names), []).append(row.path)
    return out


def split_csv(
    spark: SparkSession, path: str | Sequence[str], schema: T.StructType, quoted_newlines: bool = True, delimiter: str = ","
) -> DataFrame:
    """Rows of headered CSV files like `split_json`'s: columns found by name, whatever their order or number.

    Files are grouped by their header, each group is read once. Rejected: rows with fewer or more fields than
    their header has, since their values may stand under the wrong name. A contract's column that a header lacks is
    NULL; columns beyond the contract go into `_extra`, the second of two columns of one name too.
    """
    out = None
    for header, files in csv_headers(spark, path, delimiter).items():
        cols = [f"_{i}" for i in range(len(header))]
        # without pruning: whether a row is ragged must not depend on the columns somebody asks for
        read = spark.read.option("columnPruning", False).schema(T.StructType([T.StructField(c, T.StringType()) for c in [*cols, CORRUPT]])).csv(
            files, header=True, sep=delimiter, escape='"', multiLine=quoted_newlines, enforceSchema=True, mode="PERMISSIVE",
            columnNameOfCorruptRecord=CORRUPT,
        )
        rows = read.select(
            *cols, F.col(CORRUPT).alias("record"), F.col("_metadata.file_name").alias(FILE[0]),
            F.col("_metadata.file_modification_time").alias(FILE[1]),
        )
        place: dict[str, str] = {}
        beyond: list[tuple[str, str]] = []
        met: Counter[str] = Counter()
        for name, col in zip(header, cols):
            met[name] += 1
            if name in schema.names and met[name] == 1:
                place[name] = col
            else:
                beyond.append((name if met[name] == 1 else f"{name} ({met[name]})", col))
        n_fields = F.size(F.split(F.regexp_replace("record", '"(?:[^"]++|"")*+"', ""), f"[{delimiter}]"))
        reason = F.when(F.col("record").isNotNull(), F.when(n_fields < len(cols), "too few fields").otherwise("too many fields"))
        extra = F.map_from_arrays(F.array(*[F.lit(n) for n, _ in beyond]), F.array(*[F.col(c) for _, c in beyond])) if beyond else F.lit(None).cast("map<string,string>")
        kind = lambda c: F.when(F.col(c).isNull() | (F.trim(c) == ""), "null").when(F.col(c).rlike(_NUMBER), "number").otherwise("text")
        shape = [F.concat(F.lit(f"{n}="), kind(c)) for n, c in [*place.items(), *beyond]]
        values = {n: F.col(place[n]) if n in place else F.lit(None).cast("string") for n in schema.names}
        part = _split(rows, values, reason, extra, F.array_join(F.array_sort(F.array(*shape)), "\x1f"))
        out = part if out is None else out.unionByName(part)
    if out is not None:
        return out
    none = spark.createDataFrame([], f"{', '.join(f'`{n}` string' for n in schema.names)}, record string, {FILE[0]} string, {FILE[1]} timestamp")
    return _split(none, {n: F.col(n) for n in schema.names}, F.col("record"), F.lit(None).cast("map<string,string>"), F.lit(None).cast("string"))


def split_source(spark: SparkSession, path: str, kind: str, schema: T.StructType, quoted_newlines: bool = True) -> DataFrame:
    """One delivery of kind 'json' (arrays), 'ndjson' (an object a line) or 'csv', split as above."""
    if kind == "json":
        return split_json(json_records(spark, path), schema)
    if kind == "ndjson":
        return split_json(json_line_records(spark, path), schema)
    if kind == "csv":
        return split_csv(spark, path, schema, quoted_newlines)
    raise ValueError(f"unknown kind of source: {kind}")


def source_schema(landed: DataFrame) -> DataFrame:
    """(column_name, data_type, n_rows) of the fields that the accepted rows came with; data_type lists the kinds met, without null.

    Shapes are few, so they are counted first and taken apart afterwards.
    """
    shapes = landed.where(F.col(STATUS) == ACCEPTED).groupBy(SHAPE).agg(F.count(F.lit(1)).alias("n"))
    fields = shapes.select("n", F.explode(F.split(SHAPE, "\x1f")).alias("field")).where("field <> ''").select(
        "n", F.regexp_extract("field", "(?s)^(.*)=([a-z]+)$", 1).alias("column_name"), F.regexp_extract("field", "(?s)^(.*)=([a-z]+)$", 2).alias("kind")
    )
    kinds = F.array_join(F.array_sort(F.array_remove(F.collect_set("kind"), "null")), "|")
    return fields.groupBy("column_name").agg(kinds.alias("data_type"), F.sum("n").alias("n_rows"))
