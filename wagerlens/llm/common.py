"""What several operators need: shared tables, whole texts, word pieces, components of a graph."""

from __future__ import annotations

import json
import os
import re
import shutil
import tempfile
import uuid
from pathlib import Path

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ENCODED_WORDS = 400_000
"""A Python worker remembers the ids of so many runs, and of as many it remembered before and still meets."""


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: `spark.checkpoint.dir`; a folder of our own only where it is unset."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="wagerlens-"))
    return spark.sparkContext.getCheckpointDir()


def new_path(spark: SparkSession, tag: str) -> str:
    return f"{shared_folder(spark)}/wagerlens-{tag}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Write `df` as a table in the shared folder and read it back: lineage ends, a lost executor loses nothing."""
    spark = df.sparkSession
    path = new_path(spark, tag)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, which run its functions and may have no copy of it; once for each application."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        _shipped.add(context.applicationId)
        root = Path(__file__).resolve().parents[2]
        context.addPyFile(shutil.make_archive(f"{tempfile.mkdtemp()}/wagerlens", "zip", root, "wagerlens"))


def partitions(spark: SparkSession) -> int:
    """How many pieces a shuffle makes here; the cluster sizes it."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def whole_text(docs: DataFrame, *others: str) -> DataFrame:
    """`doc_id`, `text` (null: empty) and nothing that could clash with an operator's own columns."""
    ship_package(docs.sparkSession)
    return docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"), *others)


def id_crc(column: str = "doc_id") -> Column:
    """Unsigned crc32 of the id as text; null ids count as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary"))


def keep_rows(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of `docs` whose doc_id is in `ids`; only ids are sent to meet the documents."""
    return docs.join(ids.select("doc_id"), "doc_id", "left_semi").select(docs.columns)


# Letters, numbers and white space below U+0130, as the tokenizers tell them apart.
_L, _N, _S = "A-Za-zªµºÀ-ÖØ-öø-\u012f", "0-9²³¹¼½¾", "\\t-\\r \x85\xa0"
# How the vocabularies' own patterns cut a text, for such characters.
_TAILS = "'s|'t|'re|'ve|'m|'ll|'d"
_WORD_END = re.compile(f"{_TAILS}|[{_L}]+|[{_N}]|[^{_S}{_L}{_N}]+")
_BYTE_LEVEL = re.compile(f"{_TAILS}| ?[{_L}]+| ?[{_N}]+| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+")
PLAIN = "\u0130"
"""Texts with characters from here on are left to the tokenizer: case, composition and classes get involved."""


def _byte_characters() -> list[str]:
    """The characters by which byte-level vocabularies write the 256 bytes: printable ones as they are, others from U+0100 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = iter(range(256))
    return [chr(b) if b in shown else chr(0x100 + next(hidden)) for b in range(256)]


BYTE_CHARACTERS = _byte_characters()
_BYTES = dict(enumerate(BYTE_CHARACTERS))


class WordPieces(dict):
    """A run of characters that no merge crosses -> its ids, packed as little-endian unsigned 32-bit integers.

    The vocabulary's pattern cuts a text into such runs, so a text's ids are those of its runs in a row, and
    each run needs the tokenizer's model once. What the cut depends on is taken from the file: the vocabulary
    with word ends lower-cases and drops white space, the byte-level one keeps every byte. Texts that may
    hold a special token, or characters whose case or class needs the tokenizer's own tables, go to it.
    """

    _by_path: dict[str, "WordPieces"] = {}

    def __init__(self, path: str):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._tokenize = self._tokenizer.model.tokenize
        self._older: dict[str, bytes] = {}
        spec = json.loads(self._tokenizer.to_str())
        self._lower = spec["normalizer"] is not None
        self._runs = (_WORD_END if self._lower else _BYTE_LEVEL).findall

    @classmethod
    def of(cls, path: str) -> "WordPieces":
        """One per Python worker: workers outlive tasks."""
        if path not in cls._by_path:
            cls._by_path[path] = cls(path)
        return cls._by_path[path]

    def __missing__(self, run: str) -> bytes:
        ids = self._older.get(run)
        if ids is None:
            found = self._tokenize(run.encode().decode("latin-1").translate(_BYTES))
            ids = b"".join([t.id.to_bytes(4, "little") for t in found])
        if len(self) >= ENCODED_WORDS:
            self._older = dict(self)
            self.clear()
        self[run] = ids
        return ids

    def _whole(self, text: str) -> bytes:
        ids = self._tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(ids, "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        """The packed ids of a whole text."""
        if "<|" in text:
            return self._whole(text)
        if text and not text.isascii() and max(text) >= PLAIN:
            if not self._lower:
                return self._whole(text)
            for space in "\n\t\r":
                text = text.replace(space, " ")
            return b"".join([self._whole(w) if max(w) >= PLAIN else self.encode(w) for w in text.split(" ") if w])
        if self._lower:
            text = text.lower()
        return b"".join(map(self.__getitem__, self._runs(text)))


def connected_components(edges: DataFrame) -> DataFrame:
    """(a, b) -> (node, root), root the smallest node of the component; nodes without an edge are absent.

    Alternates two steps until nothing changes: every larger neighbour of a node is hung on the
    smallest node around it, then every smaller one. Each step is a grouped minimum (combined before
    the shuffle) and a join that adaptive execution splits when a node has very many neighbours.
    Each round is written out, so lineage stays short.
    """

    def star(pairs: DataFrame, larger: bool) -> DataFrame:
        if larger:
            around = pairs.select("a", "b").union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        else:
            around = pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = around.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        hung = around.join(least, "a")
        if larger:
            out = hung.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        else:
            out = hung.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
        return out.where("a <> b").distinct()

    def state(pairs: DataFrame) -> tuple:
        return tuple(pairs.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())

    now = materialize(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "edges")
    before, after = None, state(now)
    while after != before:
        now = materialize(star(star(now, True), False), "edges")
        before, after = after, state(now)
    # now every edge leads from a node to its root
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(now.select("b", "b").distinct())
