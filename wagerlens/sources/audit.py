"""Readiness audits of source files, before anything is loaded."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wagerlens.schemas import AUDIT_COLUMNS
from wagerlens.sources.readers import CORRUPT
from wagerlens.sources.records import json_records

_NAME = r"^[A-Za-z_][A-Za-z0-9_]*$"
_DELIMITERS = (",", ";", "\t", "|")


def _lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    return spark.read.option("lineSep", "\n").text(paths).select(
        "value",
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_size").alias("file_size"),
        # Order of a line in its file: block offset, then place within the block.
        F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row")).alias("at"),
    )


def _plain_path(path: Column) -> Column:
    """The same text for a path, whether a reader wrote it with one or three slashes."""
    return F.regexp_replace(F.url_decode(path), "^([a-z0-9]+):/+", "$1:/")


def file_audit(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(file_name, size_bytes, has_bom, has_crlf, valid_utf8, first_char) per file.

    Files are read as splittable lines of bytes, whatever their size. The reader drops a byte
    order mark, so its three bytes are what the file has more than its lines and line ends.
    The list of files comes from the folder, so files of no bytes and files of one name count.
    """
    text = F.col("value")
    first_visible = F.when(F.trim(text) != "", F.struct("at", F.substring(F.ltrim(text), 1, 1).alias("c")))
    listed = [(path,) for path in spark.read.text(paths).inputFiles()]
    files = spark.createDataFrame(listed, "path string").select(_plain_path(F.col("path")).alias("path"))
    per_file = _lines(spark, paths).groupBy(_plain_path(F.col("path")).alias("path"), "file_size").agg(
        F.sum(F.octet_length(text) + 1).alias("line_bytes"),
        F.bool_or(F.endswith(text, F.lit("\r"))).alias("has_crlf"),
        F.bool_and(F.is_valid_utf8(text)).alias("valid_utf8"),
        F.min(first_visible).alias("first"),
    )
    return files.join(per_file, "path", "left").select(
        F.element_at(F.split("path", "/"), -1).alias("file_name"),
        F.coalesce("file_size", F.lit(0)).alias("size_bytes"),
        # One byte less than counted when the last line has no line end.
        F.coalesce(F.col("file_size") - F.col("line_bytes") >= 2, F.lit(False)).alias("has_bom"),
        F.coalesce("has_crlf", F.lit(False)).alias("has_crlf"), F.coalesce("valid_utf8", F.lit(True)).alias("valid_utf8"),
        F.col("first.c").alias("first_char"),
    )


def _name_problems(names: list[str]) -> tuple[list[str], list[str]]:
    return [n for n in names if not re.match(_NAME, n)], [n for n in names if n in AUDIT_COLUMNS]


def json_record_audit(spark: SparkSession, path: str) -> DataFrame:
    """(key_set, n_rows, n_nested) per distinct key set of the records of JSON arrays.

    Files are cut into records from splittable lines, so a file of any size is many tasks. What is no JSON object counts
    under the NULL key set.
    """
    text = F.when(~F.col("outside"), F.col("record"))
    records = json_records(spark, path).select(F.from_json(text, "map<string,variant>").alias("rec"))
    nested = F.exists(F.map_values("rec"), lambda v: F.schema_of_variant(v).rlike("^(OBJECT|ARRAY)"))
    return (
        records.select(F.array_join(F.sort_array(F.map_keys("rec")), ",").alias("key_set"), nested.alias("nested"))
        .groupBy("key_set").agg(F.count("*").alias("n_rows"), F.count_if("nested").alias("n_nested"))
    )


def csv_record_audit(spark: SparkSession, path: str) -> DataFrame:
    """One row: delimiter, columns, rows, ragged rows, fields with line breaks, unusable names.

    Only the header line comes to the driver. A file without a line has no columns and no rows.
    """
    lines = spark.read.text(path).head(1)
    header = lines[0].value.rstrip("\r") if lines else ""
    delimiter = max(_DELIMITERS, key=header.count)
    names = [n.strip('"') for n in header.split(delimiter)] if lines else []
    invalid, clash = _name_problems(names)
    # Positional names: the real ones may be unusable or repeated. The reader wants one column at least.
    cols = [f"_{i}" for i in range(max(len(names), 1))]
    fields = [T.StructField(c, T.StringType()) for c in [*cols, CORRUPT]]
    rows = spark.read.schema(T.StructType(fields)).csv(
        path, header=True, sep=delimiter, multiLine=True, enforceSchema=True, columnNameOfCorruptRecord=CORRUPT
    )
    broken = [F.coalesce(F.col(c).rlike("[\r\n]"), F.lit(False)).cast("bigint") for c in cols]
    return rows.agg(
        F.count("*").alias("n_rows"),
        F.count_if(F.col(CORRUPT).isNotNull()).alias("ragged_rows"),
        F.coalesce(F.sum(sum(broken, F.lit(0))), F.lit(0)).alias("embedded_newline_fields"),
    ).select(
        F.lit(delimiter).alias("delimiter"), F.lit(len(names)).alias("n_columns"), "n_rows", "ragged_rows",
        "embedded_newline_fields", F.lit(",".join(invalid)).alias("invalid_names"), F.lit(",".join(clash)).alias("audit_clashes"),
    )


def json_name_audit(key_sets: DataFrame) -> DataFrame:
    """(name, is_valid, clashes_with_audit) of every key found by ``json_record_audit``."""
    name = F.col("name")
    return key_sets.select(F.explode(F.split("key_set", ",")).alias("name")).distinct().select(
        name, name.rlike(_NAME).alias("is_valid"), name.isin(*AUDIT_COLUMNS).alias("clashes_with_audit")
    )
