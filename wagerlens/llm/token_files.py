"""Token ids in files: documents compressed one by one with a shared zstandard dictionary, and an index to reach each.

A set of files is a folder with two tables, written and read by Spark, hence whole or absent on any store:

* `dictionary`: one row (dict_hash, content).
* `blocks`: a row for each run of consecutive documents: shard, block, dict_hash, before (tokens in
  the shard before it), tokens (in the block),
  payload (the documents' frames one after the other) and the index `docs`: doc_id, at and size of the
  frame in the payload, n_tokens.

Shards are ranges of doc_id in ascending order, blocks are numbered within a shard, and documents stand in
ascending doc_id order within a block. A frame is a zstandard frame over little-endian ids of two bytes,
or of four if the vocabulary needs them, which `dictionary` tells as `width`.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wagerlens.llm.common import WordPieces, new_path, partitions, whole_text

BLOCK_BYTES = 1 << 20
LEVEL = 3
_SAMPLE = 1 << 14
_DICTIONARY = "dict_hash string, width int, content binary"
_FRAMES = "shard int, doc_id long, n_tokens long, frame binary"
_BLOCKS = (
    "shard int, block int, dict_hash string, before long, tokens long, payload binary, "
    "docs array<struct<doc_id: long, at: long, size: long, n_tokens: long>>"
)


def train_dictionary(docs: DataFrame, vocabulary: str, end_id: int, width: int, sample: int = 2000, size: int = 65536) -> DataFrame:
    """The dictionary table, trained on the `sample` documents whose hashed ids are smallest.

    A dictionary only changes how small the frames get, so a bounded sample serves any input. Of the chosen documents
    all ids take part, in stretches of 16 KB. One task trains it, as large as the sample allows up to `size` bytes;
    a sample without anything in common leaves it empty, and frames stand alone.
    """
    chosen = docs.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    texts = whole_text(docs).join(F.broadcast(chosen), "doc_id", "left_semi")  # `sample` ids at most

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = WordPieces.of(vocabulary).encode
        for batch in batches:
            packed = [_narrow(encode(t.as_py()) + end_id.to_bytes(4, "little"), width) for t in batch.column("text")]
            parts = [ids[at : at + _SAMPLE] for ids in packed for at in range(0, len(ids), _SAMPLE)]
            yield pa.RecordBatch.from_arrays([pa.array(parts, pa.binary())], ["ids"])

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = sorted(i for batch in batches for i in batch.column(0).to_pylist())
        content, least = b"", min(size, 512)
        for wanted in (size >> k for k in range(size.bit_length())):
            if content or wanted < least:
                break
            try:
                content = zstandard.train_dictionary(wanted, ids).as_bytes()
            except zstandard.ZstdError:
                pass  # too little in common for one of this size
        yield pa.RecordBatch.from_arrays(
            [pa.array([hashlib.sha256(content).hexdigest()]), pa.array([width], pa.int32()), pa.array([content], pa.binary())],
            ["dict_hash", "width", "content"],
        )

    return texts.mapInArrow(pieces, "ids binary").repartition(1).mapInArrow(train, _DICTIONARY)


def _narrow(ids: bytes, width: int) -> bytes:
    return ids if width == 4 else np.frombuffer(ids, "<u4").astype("<u2").tobytes()


def _bounds(docs: DataFrame, pieces: int) -> list[int]:
    """Ids that cut the documents into `pieces` ranges of about as many documents each."""
    cuts = [i / pieces for i in range(1, pieces)]
    found = docs.select(F.percentile_approx(F.col("doc_id").cast("long"), cuts, 10_000).alias("cuts")).first().cuts if cuts else []
    return sorted(set(found or []))


def write_tokens(docs: DataFrame, path: str, vocabulary: str, end_id: int, width: int = 2, sample: int = 2000) -> None:
    """Encode whole texts (null: empty), `end_id` behind each, into the files under `path`.

    Each task tokenizes and compresses what it reads; only the frames are shuffled, to ranges of doc_id, where
    they are sorted and streamed into blocks of about a megabyte. Rows without an id come first; rows that
    repeat an id stand together, ordered by their frames. An empty table gives files without a block.
    """
    spark = docs.sparkSession
    train_dictionary(docs, vocabulary, end_id, width, sample).write.parquet(f"{path}/dictionary")
    dict_hash, _, content = _told(spark, path)
    bounds = np.array(_bounds(docs, partitions(spark)), np.int64)

    def frames(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = WordPieces.of(vocabulary).encode, end_id.to_bytes(4, "little")
        compress = zstandard.ZstdCompressor(level=LEVEL, dict_data=_dictionary(content), write_content_size=True).compress
        for batch in batches:
            doc = batch.column(0)
            shard = np.where(doc.is_null(), 0, np.searchsorted(bounds, doc.fill_null(0).to_numpy(), "right"))
            counts, packed = [], []
            for text in batch.column(1):
                ids = encode(text.as_py()) + end
                counts.append(len(ids) // 4)
                packed.append(compress(_narrow(ids, width)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(shard, pa.int32()), doc, pa.array(counts, pa.int64()), pa.array(packed, pa.binary())],
                ["shard", "doc_id", "n_tokens", "frame"],
            )

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, number, before, index, payload, at = None, 0, 0, [], [], 0

        def block() -> pa.RecordBatch:
            row = {
                "shard": shard, "block": number, "dict_hash": dict_hash, "before": before,
                "tokens": sum(d["n_tokens"] for d in index), "payload": b"".join(payload), "docs": index,
            }
            return pa.RecordBatch.from_pylist([row], _block_schema())

        for batch in batches:
            for one, doc, count, frame in zip(*(c.to_pylist() for c in batch.columns)):
                if index and (one != shard or at >= BLOCK_BYTES):
                    yield block()
                    number, before = (number + 1, before + sum(d["n_tokens"] for d in index)) if one == shard else (0, 0)
                    index, payload, at = [], [], 0
                shard = one
                index.append({"doc_id": doc, "at": at, "size": len(frame), "n_tokens": count})
                payload.append(frame)
                at += len(frame)
        if index:
            yield block()

    ids = whole_text(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    (
        ids.mapInArrow(frames, _FRAMES)
        .repartitionById(len(bounds) + 1, F.col("shard")).sortWithinPartitions("shard", "doc_id", "frame")
        .mapInArrow(blocks, _BLOCKS)
        .write.option("compression", "none").parquet(f"{path}/blocks")
    )


def _block_schema() -> pa.Schema:
    doc = pa.struct([(n, pa.int64()) for n in ("doc_id", "at", "size", "n_tokens")])
    return pa.schema([
        ("shard", pa.int32()), ("block", pa.int32()), ("dict_hash", pa.string()), ("before", pa.int64()), ("tokens", pa.int64()),
        ("payload", pa.binary()), ("docs", pa.list_(doc)),
    ])


def _told(spark: SparkSession, path: str) -> tuple[str, int, bytes]:
    """dict_hash, width and content; without a row, as an empty table leaves it, no dictionary."""
    row = spark.read.schema(_DICTIONARY).parquet(f"{path}/dictionary").first()
    return (row.dict_hash, row.width, bytes(row.content)) if row else (hashlib.sha256(b"").hexdigest(), 2, b"")


def _dictionary(content: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(content) if content else None


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids (packed little-endian unsigned 32-bit) of every document in the files under `path`.

    `start` counts the ids before the document in all files: those of the shards before it, a sum over a row
    for each shard, and those of its own shard, which the files tell.
    """
    dict_hash, width, content = _told(spark, path)
    stored = spark.read.schema(_BLOCKS).parquet(f"{path}/blocks")
    shards = stored.groupBy("shard").agg(F.sum("tokens").alias("tokens"))
    past = F.sum("tokens").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    shards = shards.select("shard", F.coalesce(past, F.lit(0)).alias("past"))  # a row for each shard

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        expand = zstandard.ZstdDecompressor(dict_data=_dictionary(content)).decompress
        for batch in batches:
            for row in range(batch.num_rows):
                if batch.column("dict_hash")[row].as_py() != dict_hash:
                    raise ValueError("a block was written with another dictionary")
                payload = batch.column("payload")[row].as_buffer().to_pybytes()
                shard, inside, out = batch.column("shard")[row].as_py(), batch.column("before")[row].as_py(), []
                for doc in batch.column("docs")[row].as_py():
                    ids = expand(payload[doc["at"] : doc["at"] + doc["size"]])
                    ids = ids if width == 4 else np.frombuffer(ids, "<u2").astype("<u4").tobytes()
                    if len(ids) != 4 * doc["n_tokens"]:
                        raise ValueError("a frame does not hold what its index says")
                    out.append((shard, doc["doc_id"], inside, doc["n_tokens"], ids))
                    inside += doc["n_tokens"]
                types = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
                names = ["shard", "doc_id", "inside", "n_tokens", "ids"]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

    ids = stored.mapInArrow(decode, "shard int, doc_id long, inside long, n_tokens long, ids binary")
    return ids.join(F.broadcast(shards), "shard").select("doc_id", (F.col("past") + F.col("inside")).alias("start"), "n_tokens", "ids")


def read_document(spark: SparkSession, path: str, doc_id: int) -> DataFrame:
    """One document's rows as (n_tokens, frame): the index finds it, and only its own frame leaves its block."""
    stored = spark.read.schema(_BLOCKS).parquet(f"{path}/blocks")
    doc = F.explode(F.filter("docs", lambda d: d.doc_id == doc_id)).alias("doc")
    found = stored.select("payload", doc)
    return found.select(
        "doc.n_tokens", F.substring("payload", (F.col("doc.at") + 1).cast("int"), F.col("doc.size").cast("int")).alias("frame")
    )


def token_digest(docs: DataFrame, vocabulary: str, end_id: int) -> DataFrame:
    """Write `docs` to new files in the shared folder, read them back: doc_id, start, n_tokens, ids_crc32."""
    spark = docs.sparkSession
    path = new_path(spark, "tokens")
    write_tokens(docs, path, vocabulary, end_id)
    return read_tokens(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
