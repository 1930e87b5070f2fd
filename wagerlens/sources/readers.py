"""Reading source files as text columns; typing is Bronze's job."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"


def read_json_array(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Records of pretty-printed JSON arrays, every field as text.

    An array cannot be split, so each *file* is one task: deliver many files, and read landed
    Parquet from then on.
    """
    return spark.read.schema(schema).json(path, multiLine=True)


def read_csv_strings(
    spark: SparkSession, path: str, schema: T.StructType, quoted_newlines: bool = True, keep_ragged: bool = False
) -> DataFrame:
    """Headered CSV, every field as text; the header must name the schema's columns in order.

    Short rows are filled with NULL. ``keep_ragged`` adds ``_corrupt_record``, the text of rows
    with too few or too many fields. Without quoted newlines a file splits over many tasks.
    """
    extra = [T.StructField(CORRUPT, T.StringType())] if keep_ragged else []
    return spark.read.schema(T.StructType(schema.fields + extra)).csv(
        path,
        header=True,
        multiLine=quoted_newlines,
        enforceSchema=False,
        mode="PERMISSIVE",
        columnNameOfCorruptRecord=CORRUPT,
    )
