"""Near-duplicates by SimHash: tables of distances to reference fingerprints find the pairs worth comparing."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wagerlens.llm.common import connected_components, keep_rows, materialize, whole_text

SEED = 42
CROWD = 64
"""Fingerprints that agree on a table's key are compared in pairs up to this many; more meet at the fingerprints between them."""


def shingle_hashes(text: str, width: int) -> np.ndarray:
    """XXH64 of the shingles of `width` words of a whole text, repeats included; a shorter text is one shingle, none without a word."""
    words = text.encode("utf-8", "replace").lower().split()  # on bytes: A-Z only, and white space x20, x09-x0D only
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    width = min(width, len(words))
    n = len(words) - width + 1
    spans = zip(starts[:n].tolist(), ends[width - 1 :].tolist())
    one = xxhash.xxh64_intdigest
    return np.fromiter((one(joined[a:b], SEED) for a, b in spans), np.uint64, n)


def majority(hashes: np.ndarray) -> int:
    """Signed 64-bit SimHash: the bits that are set in over half of `hashes`."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


def fingerprint(text: str, width: int) -> int:
    """Signed 64-bit SimHash over the shingles of `width` words, repeats included; 0 without a word."""
    return majority(shingle_hashes(text, width))


def fingerprints(docs: DataFrame, width: int = 3) -> DataFrame:
    """doc_id and fp of every row, over whole texts."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = pa.array([fingerprint(t.as_py(), width) for t in batch.column(1)], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), fps], ["doc_id", "fp"])

    ids = whole_text(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return ids.mapInArrow(each, "doc_id long, fp long")


def _signed(bits: int) -> int:
    return bits - (1 << 64) if bits >> 63 else bits


def _references() -> list[int]:
    """The general reference fingerprints: bit i of the k-th is the parity of i & k, so any two of them differ in just half of the bits.

    None is another's opposite, whose distances (64 less the other's) would discard nothing of their own.
    """
    return [_signed(sum(1 << i for i in range(64) if (i & k).bit_count() & 1)) for k in range(1, 64, 3)]


def _distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def linked(fps: DataFrame, max_distance: int = 2) -> DataFrame:
    """(a, b) edges whose components are those of all pairs of distinct `fps` within `max_distance` bits.

    The 64 bits are dealt into `max_distance + 2` groups. For each group there are references that hold a
    single bit of it; the distances to them, less the distance to the zero fingerprint, give a coordinate
    vector for the group, and fingerprints that are close agree on the vectors of at least two groups. Each
    pair of groups is a distance table keyed by its two vectors (packed, a bit for a coordinate), which
    makes the search an equi-join. Within a key, a pair is discarded if any of the general references is more than
    `max_distance` further from one than from the other, and survivors are verified by their own distance.

    Where more than CROWD fingerprints agree on a key they are all near one another and pairs would grow with
    the square. For distance 2 those meet at the fingerprints between them: two are within 2 bits exactly
    if some fingerprint is within 1 bit of both, so each one visits the 65 around it, at each of which no more
    than 65 can meet. That holds for distance 2 only, so no other is taken.
    """
    if max_distance != 2:
        raise ValueError("crowded keys are only resolved for a distance of 2")
    groups = max_distance + 2
    bounds = [round(64 * i / groups) for i in range(groups + 1)]
    masks = [sum(1 << bit for bit in range(a, b)) for a, b in zip(bounds, bounds[1:])]
    tables = [F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(_signed(masks[i] | masks[j]))).alias("key"))
              for t, (i, j) in enumerate(combinations(range(groups), 2))]
    pivots = F.array(*[_distance(F.col("fp"), F.lit(r)).cast("byte") for r in _references()])
    rows = fps.select("fp", pivots.alias("pivots"), F.explode(F.array(*tables)).alias("at")).select("at.t", "at.key", "fp", "pivots")
    sizes = rows.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    met = materialize(rows.join(sizes, ["t", "key"]), "tables")

    small = met.where(F.col("n") <= CROWD)
    left = small.select("t", "key", F.col("fp").alias("a"), F.col("pivots").alias("pa"))
    right = small.select("t", "key", F.col("fp").alias("b"), F.col("pivots").alias("pb"))
    apart = F.array_max(F.zip_with("pa", "pb", lambda x, y: F.abs(x.cast("int") - y.cast("int"))))
    pairs = (
        left.join(right, ["t", "key"]).where("a < b").where(apart <= max_distance)
        .where(_distance(F.col("a"), F.col("b")) <= max_distance).select("a", "b").distinct()
    )
    crowd = met.where(F.col("n") > CROWD).select("fp").distinct()
    around = F.explode(F.array(F.col("fp"), *[F.col("fp").bitwiseXOR(F.lit(_signed(1 << bit))) for bit in range(64)]))
    meetings = crowd.select("fp", around.alias("between")).groupBy("between").agg(F.collect_set("fp").alias("fps")).where("size(fps) > 1")
    hubs = meetings.select(F.array_min("fps").alias("a"), F.explode("fps").alias("b")).where("a <> b")
    return pairs.union(hubs).distinct()


def discarded(pairs: DataFrame, max_distance: int = 2) -> DataFrame:
    """(reference, share): the share of `pairs` (a, b: fingerprints) that each general reference discards by itself; the last row, with
    a null reference, is what all of them discard together. No pairs, null shares."""
    apart = [F.abs(_distance(F.col("a"), F.lit(r)) - _distance(F.col("b"), F.lit(r))) > max_distance for r in _references()]
    shares = [(F.lit(r), F.avg(gone.cast("int"))) for r, gone in zip(_references(), apart)]
    shares.append((F.lit(None).cast("long"), F.avg(F.array_contains(F.array(*apart), True).cast("int"))))
    told = F.array(*[F.struct(r.cast("long").alias("reference"), share.alias("share")) for r, share in shares])
    return pairs.agg(told.alias("told")).select(F.inline("told"))


def near_groups(docs: DataFrame, width: int = 3, max_distance: int = 2) -> DataFrame:
    """doc_id, fp, component_id of every row of `docs`; component_id is the smallest doc_id reachable over links.

    Null texts and those without a word have fingerprint 0, which links like any other. Equal fingerprints
    are one node, so copies cost nothing beyond their fingerprint. Rows that repeat a doc_id keep their own
    fingerprints. Null ids are never the smallest; a component of null ids has a null id. No rows, no result.
    """
    printed = materialize(fingerprints(docs, width), "fingerprints")
    nodes = materialize(printed.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    roots = connected_components(linked(nodes.select("fp"), max_distance))
    placed = materialize(
        nodes.join(roots, nodes.fp == roots.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root")), "placed"
    )
    least = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    return printed.join(placed.join(least, "root").select("fp", "component_id"), "fp").select("doc_id", "fp", "component_id")


def drop_near(docs: DataFrame, width: int = 3, max_distance: int = 2) -> DataFrame:
    """The rows of `docs` that stand for their group: one for each component, the one with its smallest doc_id.

    Rows without an id stay. Rows that repeat the smallest id count as one document, of which the row with the
    smallest hash of all columns stays. Columns may have any names.
    """
    return keep_least(docs, near_groups(docs, width, max_distance))


def keep_least(docs: DataFrame, groups: DataFrame) -> DataFrame:
    """One row of `docs` for each component of `groups` (doc_id, component_id), and all rows without an id."""
    named = keep_rows(docs.where("doc_id is not null"), groups.where("doc_id = component_id"))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    one = named.groupBy("doc_id").agg(F.min_by(F.struct(*columns), F.xxhash64(*columns)).alias("__row"))
    return one.select([F.col(f"__row.`{c}`").alias(c) for c in docs.columns]).unionByName(docs.where("doc_id is null"))
