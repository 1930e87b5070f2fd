"""Exact duplicates by content hash, with the bytes compared inside every group of equal hashes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wagerlens.llm.common import materialize, whole_text


def md5_128(text: Column) -> Column:
    """128-bit content hash."""
    return F.unhex(F.md5(text.cast("binary")))


def exact_dedup(docs: DataFrame, keep: str = "smallest", digest: Callable[[Column], Column] = md5_128) -> DataFrame:
    """One row per row of `docs`: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when their bytes are. They are grouped by (`digest`, text): the digest spreads and
    sorts the groups, the text in the key compares the bytes, and copies are combined before the
    shuffle, so a text crosses the network once per task that holds it, however many copies it has.
    The rows themselves then meet their group by digest alone. Only digests that two texts share,
    which a 128-bit hash leaves empty, meet by digest and text.

    Null text counts as empty. `keep` is "smallest" or "largest" doc_id of the group. Rows that repeat both
    doc_id and text are one document: all of them are marked kept or none. A null doc_id is kept only
    where its group has no other id. An empty table gives an empty result; other columns are ignored.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError("keep is 'smallest' or 'largest'")
    rows = whole_text(docs).select("doc_id", "text", digest(F.col("text")).alias("digest"))
    chosen = F.min("doc_id") if keep == "smallest" else F.max("doc_id")
    size = F.count(F.lit(1)).alias("group_size")
    sha = F.sha2(F.col("text"), 256).alias("text_sha256")

    groups = materialize(
        rows.groupBy("digest", "text").agg(chosen.alias("keep_id"), size).select("digest", "keep_id", "group_size", sha), "groups"
    )
    clashes = groups.groupBy("digest").agg(F.count(F.lit(1)).alias("texts")).where("texts > 1").select("digest")
    if clashes.isEmpty():
        found = rows.select("doc_id", "digest").join(groups, "digest")
    else:
        clashes = materialize(clashes, "clashes")
        apart = rows.join(clashes, "digest", "left_semi")
        by_text = apart.groupBy("digest", "text").agg(chosen.alias("keep_id"), size).withColumn("text_sha256", sha)
        out = ["doc_id", "keep_id", "group_size", "text_sha256"]
        sole = groups.join(clashes, "digest", "left_anti")
        found = (
            rows.select("doc_id", "digest").join(sole, "digest").select(out)
            .unionByName(apart.join(by_text, ["digest", "text"]).select(out))
        )
    return found.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def drop_exact(docs: DataFrame, keep: str = "smallest", digest: Callable[[Column], Column] = md5_128) -> DataFrame:
    """`docs` with the row of every distinct text that `exact_dedup` keeps, all columns as they were.

    The same groups, with the rest of the row as the value: texts cross the network once. A repeated row
    appears once; rows without an id stay only where no row with an id holds their text.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError("keep is 'smallest' or 'largest'")
    text = F.coalesce(F.col("text"), F.lit(""))
    nameless = F.col("doc_id").isNull()
    row = F.struct(*[F.col(c) for c in docs.columns if c != "text"], F.col("text").isNull().alias("__null"))
    best = F.min_by("__row", "__at") if keep == "smallest" else F.max_by("__row", "__at")
    at = F.struct(nameless if keep == "smallest" else ~nameless, "doc_id")
    groups = (
        docs.select(digest(text).alias("__digest"), text.alias("__text"), row.alias("__row"), at.alias("__at"))
        .groupBy("__digest", "__text").agg(best.alias("__row"))
    )
    whole = [
        (F.when(~F.col("__row.__null"), F.col("__text")) if c == "text" else F.col(f"__row.`{c}`")).alias(c)
        for c in docs.columns
    ]
    return groups.select(whole)
