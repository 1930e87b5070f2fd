"""Pack tokenized documents into sequences: minimum bin slack, by bitset subset sums over the lengths at hand."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wagerlens.llm.common import WordPieces, materialize, partitions, whole_text

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED = f"{PIECES}, sequence_id long, offset long"


def cut_documents(docs: DataFrame, vocabulary: str, end_id: int, limit: int) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every document's ids with `end_id` behind; longer ones are cut every `limit`."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = WordPieces.of(vocabulary).encode, end_id.to_bytes(4, "little")
        for batch in batches:
            out = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = encode(text.as_py()) + end
                for piece, at in enumerate(range(0, len(ids), 4 * limit)):
                    part = ids[at : at + 4 * limit]
                    out.append((doc, piece, at // 4, len(part) // 4, zlib.crc32(part)))
            columns = zip(*out) if out else [[]] * 5
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["doc_id", "piece", "start", "length", "ids_crc32"])

    docs = whole_text(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return docs.mapInArrow(pieces, PIECES)


def fullest(counts: dict[int, int], limit: int) -> dict[int, int]:
    """The largest length at hand, with the combination of the rest that leaves the least room in `limit`.

    Reachable sums are the bits of one integer; a length that is there c times is added in steps of
    1, 2, 4, ... pieces. The sums before each step tell, walking back, which steps the best sum used.
    """
    lengths = sorted(counts, reverse=True)
    first = lengths[0]
    room = limit - first
    reach, mask, steps = 1, (1 << room + 1) - 1, []
    for length in lengths:
        left = min(counts[length] - (length == first), room // length)
        step = 1
        while left > 0 and not reach >> room & 1:
            step = min(step, left)
            steps.append((length, step, reach))
            reach |= reach << length * step & mask
            left -= step
            step *= 2
        if reach >> room & 1:
            break
    total, chosen = reach.bit_length() - 1, {first: 1}
    for length, step, before in reversed(steps):
        if not before >> total & 1:
            total -= length * step
            chosen[length] = chosen.get(length, 0) + step
    return chosen


def fill_bins(counts: dict[int, int], limit: int) -> list[tuple[int, dict[int, int]]]:
    """(times, length -> pieces per bin) in order, using up all of `counts`.

    A combination is repeated as long as the lengths last, so the work depends on how many lengths
    there are (`limit` at most), not on the number of pieces.
    """
    counts, bins = {k: v for k, v in counts.items() if v > 0}, []
    while counts:
        chosen = fullest(counts, limit)
        times = min(counts[k] // n for k, n in chosen.items())
        bins.append((times, chosen))
        for k, n in chosen.items():
            counts[k] -= times * n
            if not counts[k]:
                del counts[k]
    return bins


def _places(bins: list[tuple[int, dict[int, int]]]) -> dict[int, tuple[np.ndarray, ...]]:
    """Of each length: the first rank in a run of equal bins, pieces per bin, the run's first bin, place of the first piece."""
    table: dict[int, list[tuple[int, int, int, int]]] = {}
    used: dict[int, int] = {}
    base = 0
    for times, chosen in bins:
        at = 0
        for length in sorted(chosen, reverse=True):
            table.setdefault(length, []).append((used.get(length, 0), chosen[length], base, at))
            used[length] = used.get(length, 0) + times * chosen[length]
            at += length * chosen[length]
        base += times
    return {length: tuple(np.array(c, np.int64) for c in zip(*rows)) for length, rows in table.items()}


def pack(docs: DataFrame, vocabulary: str, end_id: int, limit: int = 4096) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    The driver sees how many pieces there are of each length, `limit` numbers whatever the input, and
    plans the sequences on those. The pieces of a length are numbered where they lie: each (length, chunk)
    numbers its own and adds what the chunks before it hold, so a length that a third of all pieces share
    is spread like any other. Length and number lead to the place by a search in the plan.

    Null text is empty: a document of one end id. Repeated rows are packed as often as they occur; equal
    pieces are interchangeable. An empty table packs nothing; other columns are ignored.
    """
    spark = docs.sparkSession
    chunks = partitions(spark)
    pieces = materialize(
        cut_documents(docs, vocabulary, end_id, limit).withColumn("chunk", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(chunks)).cast("int")),
        "pieces",
    )
    counted = pieces.groupBy("length", "chunk").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1))
    starts = counted.select("length", "chunk", F.coalesce(before, F.lit(0)).alias("before"))
    have = {r.length: r.n for r in counted.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # `limit` rows at most
    places = spark.sparkContext.broadcast(_places(fill_bins(have, limit)))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(n).to_numpy() for n in ("length", "rank"))
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for one in np.unique(length):
                rows = np.flatnonzero(length == one)
                first, per_bin, base, at = places.value[int(one)]
                run = np.searchsorted(first, rank[rows], "right") - 1
                turn = rank[rows] - first[run]
                sequence[rows] = base[run] + turn // per_bin[run]
                offset[rows] = at[run] + turn % per_bin[run] * one
            kept = [batch.column(n) for n in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence), pa.array(offset)], ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    own = Window.partitionBy("length", "chunk").orderBy("doc_id", "piece", "ids_crc32")
    ranked = (
        pieces.withColumn("own", F.row_number().over(own) - F.lit(1)).join(starts, ["length", "chunk"])
        .select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("own") + F.col("before")).cast("long").alias("rank"))
    )
    return ranked.mapInArrow(place, PACKED)
