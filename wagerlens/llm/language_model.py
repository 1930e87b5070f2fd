"""Text likelihood under an n-gram model whose counts live in a log-frequency Bloom filter, one segment at a time."""

from __future__ import annotations

import os
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wagerlens.llm.common import id_crc, materialize, whole_text

BASE = 1.5  # counts are kept as powers of it
SEGMENTS = 1024
_START, _END = b" start", b" end"  # words hold no space
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
_WORDS = 250_000  # a worker's memory of words
_PART = 12 << 20  # bytes of text that are hashed together
_SHARE = 1 << 20  # bytes of text that a segment is made for


def tokens(text: str) -> list[bytes]:
    """Words between x20 and x09-x0D, A-Z lower-cased; the end is not among them."""
    return text.encode("utf-8", "replace").lower().split()


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _MIX[1]
    h = (h ^ (h >> np.uint64(27))) * _MIX[2]
    return h ^ (h >> np.uint64(31))


def pair_hash(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    """64-bit identity of a bigram."""
    return _mixed(before * _MIX[0] + _mixed(word))


class WordHashes(dict):
    """Word -> its 64-bit hash, remembered; starts anew when it holds _WORDS."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _WORDS:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h

    def line(self, words: list[bytes]) -> np.ndarray:
        """Hashes of start, words, end."""
        inner = np.fromiter(map(self.__getitem__, words), np.uint64, len(words))
        return np.concatenate([self._start, inner, self._end])

    _start, _end = (np.array([xxhash.xxh3_64_intdigest(w)], np.uint64) for w in (_START, _END))


@dataclass(frozen=True)
class Filter:
    """Bloom filters side by side, equally large; an n-gram's row among them is told by its top bits.

    An n-gram of quantised count q was added with each level 1..q. Asking level after level until one is
    absent gives q; it can come out too large, never too small, and by d levels with the d-th power of the error rate.
    """

    bits: np.ndarray  # packed
    probes: int

    def holds(self, grams: np.ndarray, level: int) -> np.ndarray:
        per = np.uint64(self.bits.shape[1] * 8 - 1)
        rows = segment_of(grams, len(self.bits)) * self.bits.shape[1]
        flat = self.bits.reshape(-1)
        alive = np.arange(len(grams))
        for at in positions(grams, level, self.probes, per):
            at = at(alive)
            hit = flat[rows[alive] + (at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8) & 1
            alive = alive[hit == 1]
            if not len(alive):
                break
        return alive

    def levels(self, grams: np.ndarray) -> np.ndarray:
        found = np.zeros(len(grams), np.int64)
        alive, level = np.arange(len(grams)), 1
        while len(alive) and level < 200:
            alive = alive[self.holds(grams[alive], level)]
            found[alive] = level
            level += 1
        return found


    @classmethod
    def of(cls, grams: np.ndarray, levels: np.ndarray, probes: int) -> "Filter":
        """One row that holds all levels of all `grams`, of as many bits as they need: at most half of them are set."""
        need = max(float(levels.sum()) * probes / np.log(2), 8.0)
        held = np.zeros(1 << int(np.ceil(np.log2(need))), np.uint8)
        for level in range(1, int(levels.max(initial=0)) + 1):
            some = grams[levels >= level]
            every = np.arange(len(some))
            for at in positions(some, level, probes, np.uint64(len(held) - 1)):
                held[at(every).astype(np.int64)] = 1
        return cls(np.packbits(held, bitorder="little")[None], probes)


def segment_of(grams: np.ndarray, segments: int) -> np.ndarray:
    """0 to segments - 1, ascending with the n-gram; up to 2^32 segments."""
    return ((grams >> np.uint64(32)) * np.uint64(segments) >> np.uint64(32)).astype(np.int64)


def positions(grams: np.ndarray, level: int, probes: int, per: np.uint64):
    """For each probe a function from row numbers to bit positions in the segment."""
    h = _mixed(grams + np.array([level], np.uint64) * _MIX[0])
    step = (h >> np.uint64(32)) | np.uint64(1)
    for i in range(probes):
        yield lambda rows, i=i: (h[rows] + np.uint64(i) * step[rows]) & per


def middle(level: np.ndarray) -> np.ndarray:
    """The count a level stands for: 0 for 0, 1 for 1, else the middle of its range of counts."""
    low, high = np.ceil(BASE ** (level - 1.0) - 1e-9), np.maximum(np.ceil(BASE ** (level * 1.0) - 1e-9) - 1, np.ceil(BASE ** (level - 1.0) - 1e-9))
    return np.where(level > 0, np.sqrt(low * high), 0.0)


def level_of(n: np.ndarray) -> np.ndarray:
    """Level 1 for a count of 1, and so on by powers of BASE; 0 for 0."""
    return np.where(n > 0, np.floor(np.log(np.maximum(n, 1)) / np.log(BASE) + 1e-9) + 1, 0).astype(np.int64)


def in_parts(docs: DataFrame) -> DataFrame:
    """(part, texts, bytes, rows): `docs` (doc_id, held_out, text) by _PART bytes of text, as compressed Arrow data; texts: those to learn from."""

    def packed(pieces: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(pieces)
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
            out.write_table(table)
        learnt = pc.sum(pc.invert(table.column("held_out"))).as_py() or 0
        size = pc.sum(pc.binary_length(table.column("text"))).as_py() or 0
        columns = [pa.array([x], pa.int64()) for x in (int.from_bytes(os.urandom(8), "little") >> 1, learnt, size)]
        return pa.RecordBatch.from_arrays([*columns, pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["part", "texts", "bytes", "rows"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, size = [], 0
        for batch in batches:
            ends, done = np.cumsum(pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False), dtype=np.int64), 0
            while done < batch.num_rows:
                before = int(ends[done - 1]) if done else 0
                stop = min(int(np.searchsorted(ends, before + _PART - size)) + 1, batch.num_rows)
                pieces.append(batch.slice(done, stop - done))
                size, done = size + int(ends[stop - 1]) - before, stop
                if size >= _PART:
                    yield packed(pieces)
                    pieces, size = [], 0
        if pieces:
            yield packed(pieces)

    return docs.select("doc_id", "held_out", "text").mapInArrow(pack, "part long, texts long, bytes long, rows binary")


@dataclass(frozen=True)
class Part:
    """The texts of a part: for each token, ends included, in a row, which of the part's words and bigrams (ascending) it is.

    begins: where each text begins; before: the place of the token before in `words`, -1 at a text's first.
    """

    rows: pa.Table
    begins: np.ndarray
    words: np.ndarray
    word: np.ndarray
    pairs: np.ndarray
    pair: np.ndarray

    @classmethod
    def read(cls, rows: bytes, hashes: WordHashes) -> "Part":
        table = pa.ipc.open_stream(rows).read_all()
        lines = [hashes.line(tokens(text.as_py())) for text in table.column("text")]
        lengths = np.array([len(x) - 1 for x in lines], np.int64)
        words = np.concatenate([x[1:] for x in lines])
        pairs = np.concatenate([pair_hash(x[:-1], x[1:]) for x in lines])
        del lines
        return cls(table.select(["doc_id", "held_out"]), lengths.cumsum() - lengths, *np.unique(words, return_inverse=True), *np.unique(pairs, return_inverse=True))

    @property
    def lengths(self) -> np.ndarray:
        return np.diff(np.append(self.begins, len(self.word)))

    def learnt(self) -> Iterator[tuple[bool, np.ndarray, np.ndarray]]:
        """For words, then bigrams: the n-grams and how often the texts to learn from hold them."""
        train = self.rows.column("held_out").fill_null(True).combine_chunks().to_numpy(zero_copy_only=False) == False  # noqa: E712
        each = np.repeat(train, self.lengths)
        yield True, self.words, np.bincount(self.word[each], minlength=len(self.words))
        yield False, self.pairs, np.bincount(self.pair[each], minlength=len(self.pairs))


@dataclass(frozen=True)
class Model:
    """What is known of the whole corpus; the counts themselves are in `segments`.

    segments: (segment, bits), a filter of all levels of all words and bigrams of each segment, as large as these need. total,
    distinct: tokens and different tokens. level_total: tokens as the levels tell them. texts: how many were learnt.
    """

    segments: DataFrame
    total: int
    distinct: int
    level_total: float
    texts: int
    weight: float

    def numbers(self) -> tuple[int, float, int, float]:
        return self.distinct, self.level_total, self.texts, self.weight


def log_likelihood(part: Part, words: np.ndarray, pairs: np.ndarray, distinct: int, level_total: float, texts: int, weight: float) -> np.ndarray:
    """log10 probability of each token of a part, from the levels of its words and bigrams.

    A word's probability by itself is smoothed with 0.1 for every word and one unknown. A bigram that the filter
    holds adds its share of the occurrences of its first word; a start occurs once in each text learnt.
    """
    counts = middle(words)[part.word]
    alone = (counts + 0.1) / (level_total + 0.1 * (distinct + 1))
    both = middle(pairs)[part.pair]
    before = np.empty(len(counts))
    before[1:] = counts[:-1]
    before[part.begins] = texts
    return np.log10((1 - weight) * alone + weight * both / np.maximum(before, np.maximum(both, 1)))


def cutoff(sizes: list[tuple[int, int]], capacity: float) -> int:
    """The smallest level c such that what lies at c or above needs no more than `capacity`; sizes: (level, need)."""
    left, cut = capacity, 1
    for level, need in sorted(sizes, reverse=True):
        left -= need
        if left < 0:
            return level + 1
    return cut


def fit(docs: DataFrame, bits: int = 1 << 29, probes: int = 8, common: int = 1_000_000, weight: float = 0.3) -> tuple[Model, DataFrame]:
    """A model of all `docs` (text; with held_out: of those that are not), and what its segments say to each part of `docs`.

    Parts of `docs` send the different n-grams that they hold to the n-grams' segments, with how often they are to be learnt. A
    segment adds up, makes its filter of as many bits as all levels of all its n-grams need, and answers each
    part from it. There are as many segments as the corpus needs, none planned for more than `bits`; no task holds more than
    one, and none is sent to all workers. Words are also answered with their exact counts, whatever `common` is.

    The second frame has part, rows (as from in_parts), and answers, an array of (word, segment, levels, counts).
    """
    if "held_out" not in docs.columns:
        docs = docs.select(F.lit(None).cast("long").alias("doc_id"), F.lit(False).alias("held_out"), "text")
    parts = materialize(in_parts(docs), "parts")
    size = parts.agg(F.sum("texts").alias("texts"), F.sum("bytes").alias("bytes")).first()
    segments = int((size.bytes or 0) // max(1, min(_SHARE, bits * np.log(2) / probes * 3))) + 1  # two n-grams in about six bytes

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        names = ["segment", "part", "word", "grams", "n"]
        for batch in batches:
            for part, rows in zip(batch.column("part"), batch.column("rows")):
                for word, grams, n in Part.read(rows.as_py(), hashes).learnt():
                    segment = segment_of(grams, segments)
                    full, from_ = np.unique(segment, return_index=True)
                    to = np.append(from_[1:], len(grams))
                    packed = [pa.array([x[a:b].tobytes() for a, b in zip(from_, to)], pa.binary()) for x in (grams, n.astype(np.uint32))]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(full, pa.int64()), pa.array(np.full(len(full), part.as_py()), pa.int64()), pa.array(np.full(len(full), word)), *packed], names
                    )

    def answer(table: pa.Table) -> pa.Table:
        parts, kinds = table.column("part").to_pylist(), np.array(table.column("word").to_pylist(), bool)
        asked = [np.frombuffer(x.as_buffer(), np.uint64) for x in table.column("grams")]
        learnt = [np.frombuffer(x.as_buffer(), np.uint32) for x in table.column("n")]
        known = {}
        for kind in (True, False):
            at = np.flatnonzero(kinds == kind)
            grams, back = np.unique(np.concatenate([np.zeros(0, np.uint64), *(asked[i] for i in at)]), return_inverse=True)
            n = np.zeros(len(grams), np.int64)
            np.add.at(n, back, np.concatenate([np.zeros(0, np.int64), *(learnt[i] for i in at)]).astype(np.int64))
            known[kind] = at, grams, back, n, level_of(n)
        held = Filter.of(*(np.concatenate([known[k][i] for k in (True, False)]) for i in (1, 4)), probes)
        levels, counts = [b""] * len(parts), [b""] * len(parts)
        for kind, (at, grams, back, n, _) in known.items():
            found, done = held.levels(grams).astype(np.uint8), 0
            for i in at:
                to = done + len(asked[i])
                levels[i] = found[back[done:to]].tobytes()
                counts[i] = n[back[done:to]].tobytes() if kind else b""
                done = to
        by_level = np.bincount(known[True][4][known[True][3] > 0])
        segment = table.column("segment")[0].as_py()
        return pa.table({
            "segment": pa.array([segment] * (len(parts) + 1), pa.int64()), "part": pa.array([*parts, None], pa.int64()),
            "word": pa.array([*kinds.tolist(), None], pa.bool_()), "levels": pa.array([*levels, None], pa.binary()),
            "counts": pa.array([*counts, None], pa.binary()), "bits": pa.array([None] * len(parts) + [held.bits.tobytes()], pa.binary()),
            "by_level": pa.array([None] * len(parts) + [by_level.tolist()], pa.list_(pa.int64())),
            "total": pa.array([None] * len(parts) + [int(known[True][3].sum())], pa.int64()),
        })

    asked = parts.select("part", "rows").mapInArrow(ask, "segment long, part long, word boolean, grams binary, n binary")
    answered = materialize(
        asked.groupBy("segment").applyInArrow(
            answer, "segment long, part long, word boolean, levels binary, counts binary, bits binary, by_level array<long>, total long"
        ), "answers",
    )
    filters = answered.where("part is null")
    total = filters.agg(F.sum("total").alias("total")).first().total or 0
    levels = filters.select(F.posexplode("by_level").alias("level", "words")).groupBy("level").agg(F.sum("words").alias("words")).orderBy("level").collect()
    level_total = float(middle(np.array([r.level for r in levels], np.int64)) @ np.array([r.words for r in levels], np.float64)) if total else 0.0
    model = Model(filters.select("segment", "bits"), total, sum(r.words for r in levels), level_total, size.texts or 0, weight)
    said = answered.where("part is not null").groupBy("part").agg(F.collect_list(F.struct("word", "segment", "levels", "counts")).alias("answers"))
    return model, parts.select("part", "rows").join(said, "part")


def score_texts(docs: DataFrame, training: Column | None = None, modulus: int = 10, **settings) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row of `docs`.

    The model learns from the rows where crc32 of the id is no multiple of `modulus`, or where `training` holds.
    base_score is exact. score uses the filter's levels of all words and bigrams, those that occur once included.

    A null or empty text is one end. Repeated rows are learnt as often as they occur and scored alike. With nothing
    to learn from, all tokens are unknown. An empty table gives no row.
    """
    held_out = ~training if training is not None else id_crc() % modulus == 0
    docs = whole_text(docs.select("doc_id", "text", held_out.alias("held_out")), "held_out")
    fitted, said = fit(docs.withColumn("doc_id", F.col("doc_id").cast("long")), **settings)
    total, numbers = fitted.total, fitted.numbers()
    size = float(np.log10(fitted.total + 0.1 * (fitted.distinct + 1)))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            for rows, answers in zip(batch.column("rows"), batch.column("answers")):
                yield scored(Part.read(rows.as_py(), hashes), answers.values)

    def scored(part: Part, answers: pa.StructArray) -> pa.RecordBatch:
        kinds, segments = answers.field("word").to_numpy(zero_copy_only=False).astype(bool), answers.field("segment").to_numpy()

        def joined(field: str, kind: bool, dtype: type) -> np.ndarray:  # segments ascend with their n-grams
            at = np.flatnonzero(kinds == kind)
            column = answers.field(field)
            return np.frombuffer(b"".join(column[int(i)].as_py() for i in at[np.argsort(segments[at])]), dtype)

        n = joined("counts", True, np.int64)
        levels = [joined("levels", kind, np.uint8).astype(np.int64) for kind in (True, False)]
        add = lambda x: np.add.reduceat(x, part.begins)
        held_out, ids = (part.rows.column(c).combine_chunks() for c in ("held_out", "doc_id"))
        return pa.RecordBatch.from_arrays(
            [
                ids, held_out, pa.array(part.lengths), pa.array(add((n > 0)[part.word].astype(np.int64))), pa.array(np.full(len(ids), total, np.int64)),
                pa.array(add(np.log10(n + 0.1)[part.word] - size)), pa.array(add(log_likelihood(part, *levels, *numbers))),
            ],
            ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
        )

    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return said.select("rows", "answers").mapInArrow(score, schema)
