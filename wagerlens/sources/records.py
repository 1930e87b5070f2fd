"""Records of JSON files as text, from splittable lines: arrays of any layout, and one object a line.

A record of an array starts at a bracket on depth 1 and ends at the one that closes it. How deep a place is depends on
all text before it, but only through a sum: strings cannot hold line ends in JSON, so a line's own brackets, strings
aside, tell what it adds. Places of a block add up within the block, blocks of a file add up over one row for each
block, and every place then knows its depth; a running number of records over the same two levels puts the text of
a record together, also where it crosses blocks. No file is one task, and all of it is built-in functions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

FILE = ("_source_file", "_delivered_at")
# Escaped backslashes and quotes stand aside as characters that JSON forbids, so that a string ends at the next quote.
_BACKSLASH, _QUOTE = "\x02", "\x01"
_TOKEN = r'("[^"]*+"|[{}\[\]]|[^"{}\[\]]++|")'


def lines_of(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Every line with its file, the file's time, and its place: block offset, then order in the block."""
    return spark.read.option("lineSep", "\n").text(path if isinstance(path, str) else list(path)).select(
        "value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_name").alias("_source_file"),
        F.col("_metadata.file_modification_time").alias("_delivered_at"),
        F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"),
    )


def _tokens(line: Column) -> Column:
    """A line cut at its brackets and strings; one without a bracket stays whole."""
    masked = F.concat(F.replace(F.replace(line, F.lit("\\\\"), F.lit(_BACKSLASH)), F.lit('\\"'), F.lit(_QUOTE)), F.lit("\n"))
    return F.when(masked.rlike(r"[{}\[\]]"), F.regexp_extract_all(masked, F.lit(_TOKEN))).otherwise(F.array(masked))


def _unmasked(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit(_QUOTE), F.lit('\\"')), F.lit(_BACKSLASH), F.lit("\\\\"))


def _carried(df: DataFrame, value: Column, name: str) -> DataFrame:
    """`df` with `name`: the sum of `value` over all that comes before in the file, `value` itself not included.

    Within a block a window over that block's rows; over blocks a window on one row for each block of a file.
    """
    own = df.withColumn("_own", value)
    past = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = own.groupBy("path", "block").agg(F.sum("_own").alias("_sum"))
    blocks = blocks.select("path", "block", F.coalesce(F.sum("_sum").over(past), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("path", "block").orderBy("row", "part").rowsBetween(Window.unboundedPreceding, -1)
    summed = own.withColumn("_inside", F.coalesce(F.sum("_own").over(inside), F.lit(0)))
    return summed.join(blocks, ["path", "block"]).withColumn(name, F.col("_before") + F.col("_inside")).drop("_own", "_inside", "_before")


def json_records(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """(record, outside, _source_file, _delivered_at): the text of every record of the arrays under `path`.

    A file whose first bracket is no `[` is taken as objects one after the other. Text that belongs to no record
    (a bare value in an array, what stands around it) comes as rows with `outside`, so that nothing of a file is
    lost. A record without its last bracket reaches to the file's end. Blank files have no record.
    """
    order = F.struct("block", "row", "part")
    cut = lines_of(spark, path).select("path", "block", "row", *FILE, F.posexplode(_tokens(F.regexp_replace("value", "\r$", ""))).alias("part", "text"))
    opens, closes = F.col("text").isin("{", "["), F.col("text").isin("}", "]")
    deep = _carried(cut, F.when(opens, 1).when(closes, -1).otherwise(0).cast("bigint"), "depth")
    roots = cut.where(opens | closes).groupBy("path").agg(F.min_by("text", order).alias("root"))  # a row for each file
    based = deep.join(roots, "path", "left").withColumn("base", F.when(F.col("root") == "[", 1).otherwise(0))
    starts = opens & (F.col("depth") == F.col("base"))
    numbered = _carried(based.withColumn("starts", starts), F.col("starts").cast("bigint"), "earlier")
    inside = F.col("starts") | (F.col("depth") > F.col("base"))
    number = (F.col("earlier") + F.col("starts").cast("bigint")).alias("number")
    pieces = F.sort_array(F.collect_list(F.struct("block", "row", "part", "text")))
    whole = (
        numbered.where(inside).groupBy("path", number, *FILE).agg(pieces.alias("pieces"))
        .select(_unmasked(F.trim(F.array_join(F.transform("pieces", lambda p: p.text), ""))).alias("record"), F.lit(False).alias("outside"), *FILE)
    )
    stray = _unmasked(F.regexp_replace("text", r"^[\s,]+|[\s,]+$", ""))
    around = numbered.where(~inside & ~opens & ~closes).select(stray.alias("record"), F.lit(True).alias("outside"), *FILE)
    return whole.unionByName(around.where("record <> ''"))


def json_line_records(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """(record, outside, _source_file, _delivered_at): every line that is not blank; it is one record."""
    lines = lines_of(spark, path).withColumn("record", F.regexp_replace("value", "\r$", ""))
    return lines.where(F.trim("record") != "").select("record", F.lit(False).alias("outside"), *FILE)
