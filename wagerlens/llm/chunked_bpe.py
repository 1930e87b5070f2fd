"""BPE encoding by content-defined chunks: what documents share is encoded once, joins are repaired until both sides agree.

A rolling hash over the last bytes cuts a text wherever the hash says so, so a passage is cut alike wherever it
stands. Chunks met more than once are shuffled by their hash, encoded once, and their ids sent back to
their documents, whose other chunks meet them there; a document that shares nothing is encoded where it lies. A cut ignores words, so ids beside a join may be wrong: the
text around each join is encoded again, from one place where no pretoken can cross to another.

This is for byte-level vocabularies of fewer than 65,536 ids, whose pretokens never hold white space behind other characters and
whose tokens give back the bytes of a text.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wagerlens.llm.common import BYTE_CHARACTERS, PLAIN, WordPieces, ship_package, whole_text

WINDOW = 32
MEAN, LEAST, MOST = 512, 128, 4096
"""Bytes of a chunk: the mean distance of cuts (a power of two), the least, and the most before a cut is forced."""
FILTER_BITS = 26
"""The filter of repeated chunks has 2 to this many bits (8 MB) at any size of the input. Fuller filters let more chunks
through that occur once; those are shuffled in vain, with the same result."""
# Where no pretoken crosses: white space behind a character that is none (ASCII; two bytes from U+00C0; three from U+4000 to U+CFFF).
_SYNC = re.compile(rb"(?:[\x21-\x7E]|[\xC3-\xDF][\x80-\xBF]|[\xE4-\xEC][\x80-\xBF][\x80-\xBF])(?=[ \n\t\r])")


def _gears() -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(bytes([b]), 13) for b in range(256)], np.uint64)


_GEARS = _gears()


def cuts(raw: bytes) -> list[int]:
    """Ends of the chunks of a text in UTF-8: 0 < end, ..., len(raw). Never inside a character."""
    n = len(raw)
    if n <= LEAST:
        return [n] if n else []
    data = np.frombuffer(raw, np.uint8)
    rolling = _GEARS[data]
    width = 1
    while width < WINDOW:  # the hash of the last 2w bytes from those of the last w, here and w before
        longer = rolling.copy()
        longer[width:] += rolling[:-width] << np.uint64(width)
        rolling, width = longer, 2 * width
    starts = np.append((data & 0xC0) != 0x80, True)  # a character begins here; the end counts as one
    wanted = np.flatnonzero((rolling >> np.uint64(WINDOW)) & np.uint64(MEAN - 1) == 0) + 1
    out, last = [], 0
    for at in [*wanted[starts[wanted]].tolist(), n]:
        while at - last > MOST:
            forced = last + MOST
            while not starts[forced]:
                forced -= 1
            out.append(forced)
            last = forced
        if at == n or at - last >= LEAST:
            if at > last:
                out.append(at)
            last = at
    return out


ROWS = 256
"""Documents that a task holds as Python values at a time."""


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield batch.slice(at, ROWS)


def _pieces(raw: bytes) -> list[bytes]:
    ends = cuts(raw)
    return [raw[a:b] for a, b in zip([0, *ends], ends)]


def _low(digest: bytes) -> int:
    return int.from_bytes(digest[:8], "little", signed=True)


def repeated_filter(docs: DataFrame) -> np.ndarray:
    """Words of a bitmap that has the bit of every chunk hash met more than once."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = [_low(xxhash.xxh3_128_digest(p)) for t in batch.column("text") for p in _pieces(t.as_py().encode())]
            one, n = np.unique(np.array(hashes, np.int64), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(one), pa.array(n.astype(np.int64))], ["hash", "n"])

    seen = whole_text(docs).mapInArrow(count, "hash long, n long").groupBy("hash").agg(F.sum("n").alias("n"))
    bit = F.col("hash").bitwiseAND((1 << FILTER_BITS) - 1)
    word = F.shiftright(bit, 6).cast("int").alias("word")
    flag = F.call_function("shiftleft", F.lit(1).cast("long"), bit.bitwiseAND(63).cast("int")).alias("flag")
    words = seen.where("n > 1").select(word, flag).groupBy("word").agg(F.bit_or("flag").alias("flags")).toArrow()
    bits = np.zeros(1 << FILTER_BITS - 6, np.int64)
    bits[words.column("word").to_numpy()] = words.column("flags").to_numpy()
    return bits


def _repeated(bits: np.ndarray, hashes: list[int]) -> np.ndarray:
    at = np.array(hashes, np.int64) & ((len(bits) << 6) - 1)
    return (bits[at >> 6] >> (at & 63) & 1).astype(bool)


def _hashed(raw: bytes, bits: np.ndarray) -> Iterator[tuple[bytes, bytes, bool]]:
    """(chunk, its 128-bit hash, whether it may occur elsewhere) in order."""
    pieces = _pieces(raw)
    digests = [xxhash.xxh3_128_digest(p) for p in pieces]
    return zip(pieces, digests, _repeated(bits, [_low(d) for d in digests]).tolist())


def _batch(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)


def encode_repeated(docs: DataFrame, vocabulary: str, bits: Broadcast) -> DataFrame:
    """chunk (hash) and ids (two bytes each) of every repeated chunk, once."""

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            found = {d: p for t in batch.column("text") for p, d, often in _hashed(t.as_py().encode(), bits.value) if often}
            yield _batch(list(found.items()), ["chunk", "piece"], [pa.binary(), pa.binary()])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = Joiner.of(vocabulary).ids
        for batch in _slices(batches):
            ids = [of(p).tobytes() for p in batch.column("piece").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("chunk"), pa.array(ids, pa.binary())], ["chunk", "ids"])

    once = whole_text(docs).mapInArrow(texts, "chunk binary, piece binary").dropDuplicates(["chunk", "piece"])
    return once.mapInArrow(encode, "chunk binary, ids binary")


def token_bytes(vocabulary: str) -> list[bytes]:
    """The bytes that each id stands for."""
    from tokenizers import Tokenizer

    back = {c: b for b, c in enumerate(BYTE_CHARACTERS)}
    tokens = Tokenizer.from_file(vocabulary).get_vocab()
    out = [b""] * (max(tokens.values()) + 1)
    for token, number in tokens.items():
        out[number] = bytes(back[c] for c in token) if all(c in back for c in token) else token.encode()
    return out


def _by_ranks(vocabulary: str, tokens: list[bytes]):
    """The vocabulary as ranks, or None where its ids do not follow its merges."""
    import public_tokenizers
    import tiktoken

    spec = json.loads(Path(vocabulary).read_text())
    pairs = [pair.split(" ") if isinstance(pair, str) else pair for pair in spec["model"]["merges"]]
    ids = spec["model"]["vocab"]
    if any(ids.get(a + b) != 256 + rank for rank, (a, b) in enumerate(pairs)):
        return None
    ranks = {tokens[number]: number for number in range(256 + len(pairs))}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


class Decoder:
    """Bytes of ids; one of each kind and vocabulary per Python worker."""

    _made: dict[tuple[type, str], Decoder] = {}

    def __init__(self, vocabulary: str):
        self.tokens = token_bytes(vocabulary)

    @classmethod
    def of(cls, vocabulary: str):
        if (cls, vocabulary) not in cls._made:
            cls._made[cls, vocabulary] = cls(vocabulary)
        return cls._made[cls, vocabulary]

    def decode(self, ids: np.ndarray) -> bytes:
        tokens = self.tokens
        return b"".join([tokens[i] for i in ids.tolist()])


class Joiner(Decoder):
    """Encodes pieces of a text and puts their ids together, as if the text had been encoded whole.

    Where the file numbers its tokens in the order of its merges, ranks say all that the merges say, and the
    quick library for ranks gives the same ids; texts that may hold a special token, or characters whose class
    depends on a library's Unicode tables, go to the tokenizers library itself.
    """

    def __init__(self, vocabulary: str):
        super().__init__(vocabulary)
        self._whole = WordPieces.of(vocabulary)
        self._quick = _by_ranks(vocabulary, self.tokens)
        self._sizes = np.array([len(t) for t in self.tokens], np.int64)

    def ids(self, raw: bytes) -> np.ndarray:
        text = raw.decode()
        if self._quick is None or "<|" in text or not text.isascii() and max(text) >= PLAIN:
            return np.frombuffer(self._whole.encode(text), "<u4").astype("<u2")
        return np.array(self._quick.encode_ordinary(text), "<u2")

    def join(self, parts: list[tuple[bytes, np.ndarray]]) -> np.ndarray:
        """Ids of the concatenated texts, from each part's own text and ids.

        A part keeps its ids between its first and its last sync, a place that is a boundary of pretokens whatever
        stands around it. All between two parts' kept stretches is encoded again, with one more stretch of either
        side as a guard; both guards must come out as they were kept, else the next sync outwards is taken.
        """
        if len(parts) == 1:
            return parts[0][1]
        raw = b"".join(text for text, _ in parts)
        at = 0
        kept: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # places of syncs in raw, their id places, the part's ids
        for text, ids in parts:
            found = np.array([m.end() for m in _SYNC.finditer(text)], np.int64)
            if len(found):
                ends = np.cumsum(self._sizes[ids])
                where = np.searchsorted(ends, found)
                real = ends[np.minimum(where, len(ends) - 1)] == found
                if not real.all():
                    raise ArithmeticError("a token crosses white space: not a byte-level vocabulary")
                kept.append((found + at, where + 1, ids))
            at += len(text)
        # The start and the end of the text are syncs without ids of their own.
        nothing = np.zeros(0, "<u2")
        rows = [(np.zeros(1, np.int64), np.zeros(1, np.int64), nothing), *kept, (np.array([len(raw)]), np.zeros(1, np.int64), nothing)]
        out: list[np.ndarray] = []
        begin = 0  # the sync of the left row from which its ids are still to be put out
        for (places, numbers, ids), (next_places, next_numbers, next_ids) in zip(rows, rows[1:]):
            back, ahead = len(places) - 1, 0
            while True:
                guard, front = max(back - 1, begin), min(ahead + 1, len(next_places) - 1)
                window = self.ids(raw[int(places[guard]) : int(next_places[front])])
                left = ids[int(numbers[guard]) : int(numbers[back])]
                right = next_ids[int(next_numbers[ahead]) : int(next_numbers[front])]
                agree = np.array_equal(window[: len(left)], left) and np.array_equal(window[len(window) - len(right) :], right)
                if agree or (guard == begin and front == len(next_places) - 1):
                    break
                back, ahead = guard, front
            out += [ids[int(numbers[begin]) : int(numbers[guard])], window]
            begin = front
        return np.concatenate(out) if out else nothing


def encode_documents(docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, ids (packed little-endian unsigned 32-bit) and text_sha256 of every row, over whole texts (null: empty).

    The ids are those that the tokenizers library gives without added special tokens; a special token's string in a
    text is that token. Each document's ids must give back its text, which is checked here: chunks are known
    by 128-bit hashes, and one that met another's ids would raise. Repeated rows and ids are encoded each for
    itself; an empty table has no result. Other columns are ignored.
    """
    spark = docs.sparkSession
    ship_package(spark)
    bits = spark.sparkContext.broadcast(repeated_filter(docs))  # 2 ** FILTER_BITS bits
    ids = whole_text(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                raw = text.encode()
                own = hashlib.sha256(raw).digest()
                rows += [(doc, own, i, d) for i, (_, d, often) in enumerate(_hashed(raw, bits.value)) if often]
            yield _batch(rows, ["doc_id", "own", "at", "chunk"], [pa.int64(), pa.binary(), pa.int32(), pa.binary()])

    def rest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3).compress
        for batch in _slices(batches):
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                raw = text.encode()
                pieces = [(p, often) for p, _, often in _hashed(raw, bits.value)]
                if any(often for _, often in pieces):
                    sizes = [0 if often else len(p) for p, often in pieces]
                    rows.append((doc, hashlib.sha256(raw).digest(), sizes, press(b"".join(p for p, often in pieces if not often))))
            types = [pa.int64(), pa.binary(), pa.list_(pa.int32()), pa.binary()]
            yield _batch(rows, ["doc_id", "own", "sizes", "rest"], types)

    def done(rows: list[tuple[int, np.ndarray, bytes]], joiner: Joiner) -> pa.RecordBatch:
        for doc, whole, own in rows:
            if hashlib.sha256(joiner.decode(whole)).digest() != own:
                raise ArithmeticError(f"the ids of document {doc} do not give back its text")
        found = [(doc, whole.astype("<u4").tobytes(), own.hex()) for doc, whole, own in rows]
        return _batch(found, ["doc_id", "ids", "text_sha256"], [pa.int64(), pa.binary(), pa.string()])

    def alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        joiner = Joiner.of(vocabulary)
        for batch in _slices(batches):
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                raw = text.encode()
                if not any(often for _, _, often in _hashed(raw, bits.value)):
                    rows.append((doc, joiner.ids(raw), hashlib.sha256(raw).digest()))
            yield done(rows, joiner)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        joiner, expand = Joiner.of(vocabulary), zstandard.ZstdDecompressor().decompress
        for batch in _slices(batches):
            rows = []
            for row in batch.to_pylist():
                raw, shared = expand(row["rest"]), {s["at"]: s["ids"] for s in row["shared"]}
                parts, at, run = [], 0, 0
                for i, size in enumerate(row["sizes"]):
                    at += size
                    if not size:  # neighbours that nobody else has are one part
                        if at > run:
                            parts.append((raw[run:at], joiner.ids(raw[run:at])))
                        run = at
                        known = np.frombuffer(shared[i], "<u2")
                        parts.append((joiner.decode(known), known))
                if at > run:
                    parts.append((raw[run:at], joiner.ids(raw[run:at])))
                rows.append((row["doc_id"], joiner.join(parts), row["own"]))
            yield done(rows, joiner)

    once = encode_repeated(docs, vocabulary, bits)
    met = ids.mapInArrow(links, "doc_id long, own binary, at int, chunk binary").join(once, "chunk")
    shared = met.groupBy("doc_id", "own").agg(F.collect_list(F.struct("at", "ids")).alias("shared"))  # one document's chunks
    shared = shared.select(F.col("doc_id").alias("shared_id"), F.col("own").alias("shared_own"), "shared")
    whole = ids.mapInArrow(rest, "doc_id long, own binary, sizes array<int>, rest binary")
    same = F.col("doc_id").eqNullSafe(F.col("shared_id")) & (F.col("own") == F.col("shared_own"))
    joined = whole.join(shared, same).select("doc_id", "own", "sizes", "rest", "shared")
    out = "doc_id long, ids binary, text_sha256 string"
    return ids.mapInArrow(alone, out).unionByName(joined.mapInArrow(finish, out))


def decode_documents(encoded: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id and the text that each row's packed `ids` stand for, special tokens included; null ids give an empty text."""
    ship_package(encoded.sparkSession)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        back = Decoder.of(vocabulary).decode
        for batch in _slices(batches):
            texts = [back(np.frombuffer(i or b"", "<u4")).decode("utf-8", "replace") for i in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(decode, "doc_id long, text string")


def bpe_digest(docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (decimal ids joined by commas) and decoded_sha256 of every row, ids encoded and decoded again."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder.of(vocabulary)
        decimal = [str(i).encode() for i in range(len(decoder.tokens))]
        sha = hashlib.sha256
        for batch in _slices(batches):
            rows = []
            for doc, packed in zip(batch.column("doc_id").to_pylist(), batch.column("ids").to_pylist()):
                ids = np.frombuffer(packed, "<u4")
                text = decoder.decode(ids).decode("utf-8", "replace").encode()
                written = b",".join([decimal[i] for i in ids.tolist()])
                rows.append((doc, len(ids), sha(written).hexdigest(), sha(text).hexdigest()))
            types = [pa.int64(), pa.int64(), pa.string(), pa.string()]
            yield _batch(rows, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"], types)

    encoded = encode_documents(docs, vocabulary).select("doc_id", "ids")
    return encoded.mapInArrow(digest, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
