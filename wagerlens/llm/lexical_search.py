"""Ranked lexical search: one Aho-Corasick automaton over all query terms reads the documents; there is no document index.

Terms are guarded by a boundary on each side, so the automaton finds whole terms only and its outputs count
tf straight from the text. An output is a term's number, which leads to the items that hold the term.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from operator import itemgetter

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wagerlens.llm.common import materialize, partitions, ship_package

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
BLOCK_BYTES = 16 << 20
"""Terms of the items that one automaton may hold, as bytes of text; more items take more automata, each with its own scan."""
CELLS = 1 << 21
"""Scores (documents times items) that a task holds at a time."""
_GUARD = 0x20
_COUNTS = "doc_id long, n long, terms array<int>, tfs array<long>"
_TOPS = "item int, score long, doc_id long, task int"


def _folded() -> bytes:
    """For `bytes.translate`: A-Z to a-z, every other byte that no term holds to the guard."""
    table = bytearray(range(256))
    for a, b in ((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F)):
        table[a : b + 1] = bytes([_GUARD]) * (b + 1 - a)
    table[0x41:0x5B] = bytes(range(0x61, 0x7B))
    return bytes(table)


_FOLDED = _folded()


def terms_of(text) -> F.Column:
    """The terms of a text column in order, A-Z lower-cased; null has none."""
    lower = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.regexp_extract_all(F.coalesce(lower, F.lit("")), F.lit(f"({TERM})"))


def _per_item(items: DataFrame) -> DataFrame:
    """item_id and its distinct terms, each once; rows of one item_id are one item."""
    listed = items.select("item_id", F.explode(terms_of(F.col("text"))).alias("term")).distinct()
    return listed.groupBy("item_id").agg(F.sort_array(F.collect_list("term")).alias("terms"))


def _blocks(per_item: DataFrame) -> Iterator[list[tuple]]:
    """The items dealt by their hash into as many blocks as keep BLOCK_BYTES of terms each on average, read one after another."""
    size = F.aggregate("terms", F.lit(0).cast("long"), lambda total, term: total + F.octet_length(term) + 8)
    total = per_item.agg(F.sum(size).alias("size")).first().size or 0
    count = max(1, -(-2 * total // BLOCK_BYTES))  # half full on average: hashing is uneven
    for block in range(count):
        rows = per_item.where(F.pmod(F.xxhash64("item_id"), F.lit(count)) == block).orderBy("item_id").collect()  # BLOCK_BYTES
        if rows:
            yield [(r.item_id, r.terms) for r in rows]


_automata: dict[int, ahocorasick.Automaton] = {}


def automaton(shared: Broadcast) -> ahocorasick.Automaton:
    """The automaton of the broadcast terms, built once in each Python worker. Bytes stand as Latin-1 characters."""
    if shared._path not in _automata:
        built = ahocorasick.Automaton()
        for number, term in enumerate(shared.value):
            built.add_word(f" {term.encode().decode('latin-1')} ", number)
        if len(built):
            built.make_automaton()
        _automata.clear()
        _automata[shared._path] = built
    return _automata[shared._path]


def count_terms(docs: DataFrame, terms: Broadcast) -> DataFrame:
    """doc_id, n (terms of the text with repeats), terms (numbers of those found) and tfs, for each document with a term."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = automaton(terms)
        number = itemgetter(1)
        for batch in batches:
            ids, ns, offsets, flat, tfs = [], [], [0], [], []
            for doc, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                text = raw.translate(_FOLDED)
                n = len(text.split())
                if not n:
                    continue
                counted = Counter(map(number, found.iter(f" {text.decode('latin-1')} "))) if len(found) else {}
                ids.append(doc)
                ns.append(n)
                flat += counted.keys()
                tfs += counted.values()
                offsets.append(len(flat))
            cuts = pa.array(offsets, pa.int32())
            arrays = [
                pa.array(ids, pa.int64()), pa.array(ns, pa.int64()),
                pa.ListArray.from_arrays(cuts, pa.array(flat, pa.int32())), pa.ListArray.from_arrays(cuts, pa.array(tfs, pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n", "terms", "tfs"])

    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("raw")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), raw).mapInArrow(scan, _COUNTS)


def _best(item: np.ndarray, score: np.ndarray, doc: np.ndarray, missing: np.ndarray, k: int) -> np.ndarray:
    """Places of each item's `k` best: highest score, then smallest id; rows without an id behind those with one."""
    order = np.lexsort((doc, missing, -score, item))
    ranked = item[order]
    rank = np.arange(len(order)) - np.searchsorted(ranked, ranked, "left")
    return order[rank < k]


def _tops(counts: DataFrame, model: Broadcast, k: int) -> DataFrame:
    """Each task's `k` best documents of each item."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        weight, starts, holders, n_items, docs, total = model.value
        held = [np.zeros(0, np.int64)] * 3 + [np.zeros(0, bool)]  # item, score, doc, missing
        least = np.ones(n_items, np.int64)  # what a document needs to be among an item's best so far
        at_once = max(1, CELLS // max(1, n_items))

        def pruned() -> None:
            nonlocal held
            held = [a[_best(*held, k)] for a in held]
            full = np.bincount(held[0], minlength=n_items) >= k
            lowest = np.full(n_items, np.iinfo(np.int64).max)
            np.minimum.at(lowest, held[0], held[1])
            least[full] = np.maximum(lowest[full], 1)

        def scored(ids, n, offsets, term, tf) -> None:
            nonlocal held
            rows = np.repeat(np.arange(len(n)), np.diff(offsets))
            m = 50 + 50 * n * docs // total  # 100 - 50 + a share of the mean length, of 50
            part = weight[term] * (1_000_000_000 * tf // (1000 * tf + 20 * m[rows]))
            fan = starts[term + 1] - starts[term]
            places = np.arange(fan.sum()) - np.repeat(np.cumsum(fan) - fan, fan) + np.repeat(starts[term], fan)
            cell = np.repeat(rows, fan) * n_items + holders[places]
            each = np.repeat(part, fan)
            size = len(n) * n_items
            # bincount adds doubles: high and low halves stay exact
            high, low = (np.bincount(cell, h, size).astype(np.int64) for h in (each >> 24, each & 0xFFFFFF))
            sums = ((high << 24) + low).reshape(len(n), n_items)
            doc, item = np.nonzero(sums >= least)
            missing = ids.is_null().to_numpy(False)
            number = ids.fill_null(0).to_numpy()
            held = [np.concatenate(p) for p in zip(held, (item, sums[doc, item], number[doc], missing[doc]))]
            if len(held[0]) > 4 * k * n_items + 4096:
                pruned()

        for batch in batches:
            for at in range(0, batch.num_rows, at_once):
                part = batch.slice(at, at_once)
                offsets = part.column("terms").offsets.to_numpy().astype(np.int64)
                term, tf = _values(part.column("terms")), _values(part.column("tfs"))
                scored(part.column("doc_id"), part.column("n").to_numpy(), offsets, term, tf)
        pruned()
        item, points, doc, missing = held
        task = np.full(len(item), TaskContext.get().partitionId())
        columns = [pa.array(item, pa.int32()), pa.array(points, pa.int64()), pa.array(doc, pa.int64(), mask=missing), pa.array(task, pa.int32())]
        yield pa.RecordBatch.from_arrays(columns, ["item", "score", "doc_id", "task"])

    return counts.mapInArrow(score, _TOPS)


def _values(lists: pa.ListArray) -> np.ndarray:
    offsets = lists.offsets.to_numpy()
    return lists.values.to_numpy()[int(offsets[0]) : int(offsets[-1])].astype(np.int64)


def _ranked(rows: DataFrame, k: int, *group: str) -> DataFrame:
    order = Window.partitionBy(*group).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(docs: DataFrame, items: DataFrame, k: int = 50) -> DataFrame:
    """item_id, rank, doc_id, score: the `k` best documents of every item, with scores above 0.

    A block of items takes two passes: the automaton counts tf of its terms in every whole text, once, into a
    table of numbers; then, df being known, each task scores its documents for all items that their terms
    lead to and keeps `k` for each item. Only those meet, first those of some tasks, then of all, so the
    final ranking sees few rows of an item however many documents there are. Scores are 64-bit integers.

    Documents and items that are null, empty or without a term take no part. Rows of one item_id (null is one)
    are one item. Rows that repeat a doc_id are ranked each for itself; among equal scores ids ascend and
    rows without an id come last. Without documents or items there are no rows. Other columns are ignored.
    """
    spark = docs.sparkSession
    ship_package(spark)
    kind = items.schema["item_id"].dataType.simpleString()
    out = spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    found: list[DataFrame] = []
    for block in _blocks(materialize(_per_item(items), "items")):
        terms = sorted({t for _, own in block for t in own})
        counts = materialize(count_terms(docs, spark.sparkContext.broadcast(terms)), "counts")
        n_docs, total = counts.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
        if not n_docs:
            return out
        having = counts.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
        idf = F.floor(F.lit(1000) * F.ln((2 * F.lit(n_docs) + 2).cast("double") / (2 * F.col("df") + 1).cast("double")))
        weight = np.zeros(len(terms), np.int64)
        for row in having.select("term", idf.cast("long").alias("w")).collect():  # a row for each term of the block
            weight[row.term] = row.w
        number = {t: i for i, t in enumerate(terms)}
        holders: list[list[int]] = [[] for _ in terms]
        for i, (_, own) in enumerate(block):
            for t in own:
                holders[number[t]].append(i)
        starts = np.concatenate([[0], np.cumsum([len(h) for h in holders])]).astype(np.int64)
        flat = np.array([i for h in holders for i in h], np.int64)
        model = spark.sparkContext.broadcast((weight, starts, flat, len(block), n_docs, total))
        tops = _tops(counts, model, k).withColumn("group", F.pmod("task", F.lit(max(1, round(partitions(spark) ** 0.5)))))
        best = _ranked(_ranked(tops, k, "item", "group").drop("rank"), k, "item")
        names = spark.createDataFrame([(i, item) for i, (item, _) in enumerate(block)], f"item int, item_id {kind}")
        found.append(best.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"))  # the block's items
    for each in found:
        out = out.unionByName(each)
    return out
