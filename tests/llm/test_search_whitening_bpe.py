"""Lexical search, whitening and chunked BPE against plain versions, on rows with nulls, ties, repeats and empty or long texts."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from wagerlens.llm import chunked_bpe, lexical_search, queries, whitening
from wagerlens.llm.common import WordPieces

FOLDER = "/root/testdata/sf0.001"
BYTE_LEVEL = public_tokenizers.path("byte_bpe_50k.json")
WORD_END = public_tokenizers.path("word_bpe_49k.json")
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ASCII_LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def some_texts(seed):
    rng = random.Random(seed)
    stems = "the of Lorem ipsum dolor café ÉCOLE straße 12 x9 中文 stone".split()
    line = lambda n: "".join(rng.choice(stems) + rng.choice([" ", " ", ", ", ".\n", "\t", "-", "'s "]) for _ in range(n))
    shared = line(200)
    texts = [line(rng.randint(1, 60)) for _ in range(40)] + [line(300) + shared + line(200) for _ in range(6)]
    texts += [texts[0]] * 5 + [None, "", " \n", ".,;", "\x00a\x00", "a", "A", "the the the", line(6000), "same " * 3000, "x" * 9000, "é" * 5000]
    return texts + ["before <|endoftext|> after " * 60, "<|ENDOFTEXT|>", "İ   \u0085 　 ́e"]


def as_documents(spark, texts):
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, texts[3]), (7, texts[7]), (7, texts[7]), (7, "another of the same id")]
    clash = ["rank", "score", "n", "terms", "task", "group", "ids", "chunk", "own", "rest", "term", "item", "shared", "hash"]
    return spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3).withColumns({c: F.lit("clash") for c in clash}), rows


def plain_search(docs, items, k):
    terms = lambda t: TERM.findall((t or "").translate(ASCII_LOWER))
    read = [(i, Counter(terms(t))) for i, t in docs]
    read = [(i, c, c.total()) for i, c in read if c]
    n_docs, total = len(read), sum(n for _, _, n in read)
    df = Counter(w for _, c, _ in read for w in c)
    asked = {}
    for item, text in items:
        asked.setdefault(item, set()).update(terms(text))
    out = []
    for item, own in asked.items():
        found = []
        for i, c, n in read:
            m = 100 - 50 + (50 * n * n_docs) // total
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * ((1000000000 * c[w]) // (1000 * c[w] + 20 * m)) for w in own if w in c
            )
            if score > 0:
                found.append((-score, i is None, i or 0))
        out += [(item, rank, None if gone else i, -s) for rank, (s, gone, i) in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("k", [1, 3, 50])
@pytest.mark.parametrize("block_bytes", [1 << 24, 300])
def test_search(spark, monkeypatch, k, block_bytes):
    monkeypatch.setattr(lexical_search, "BLOCK_BYTES", block_bytes)  # one automaton, and many with a scan each
    monkeypatch.setattr(lexical_search, "CELLS", 40)
    docs, rows = as_documents(spark, some_texts(1))
    asked = [(1, "The stone of café"), (2, "ipsum ÉCOLE école 12"), (3, None), (4, ""), (5, "nowhere"), (6, "the " * 9), (None, "dolor x9"), (1, "straße")]
    asked += [(10 + i, t) for i, t in enumerate(some_texts(2)[:12])]
    items = spark.createDataFrame(asked, "item_id bigint, text string").withColumn("terms", F.lit("clash"))
    got = lexical_search.search(docs, items, k)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain_search(rows, asked, k)


def test_search_without_rows(spark):
    docs, _ = as_documents(spark, ["a b"] * 4 + ["c"] * 4)
    none, blank = docs.limit(0), spark.createDataFrame([(1, None)], "doc_id bigint, text string")
    items = spark.createDataFrame([(1, "a")], "item_id bigint, text string")
    assert lexical_search.search(none, items).count() == 0
    assert lexical_search.search(blank, items).count() == 0
    assert lexical_search.search(docs, items.limit(0)).count() == 0


def test_scores_beyond_doubles_are_exact(spark):
    words = [f"w{i}" for i in range(3000)]
    docs = spark.createDataFrame([(0, " ".join(words * 3))] + [(i, "other") for i in range(1, 40)], "doc_id bigint, text string")
    items = spark.createDataFrame([(0, " ".join(words)), (1, "w1")], "item_id bigint, text string")
    got = sorted(tuple(r) for r in lexical_search.search(docs, items).collect())
    assert got == plain_search([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()], 50)


# whitening


def solved(rows):
    sigma, v = whitening.directions(np.linalg.qr(rows, mode="r"))
    want = np.linalg.svd(rows, compute_uv=False)
    assert np.abs(sigma - want).max() <= 1e-13 * want[0]
    kept = v.shape[1]
    assert kept == np.sum(want > 4 * len(want) * 2.3e-16 * want[0])  # a value of zero has no direction of its own
    assert np.abs(v.T @ v - np.eye(kept)).max() < 1e-11
    assert np.abs(rows.T @ (rows @ v) - v * sigma[:kept] ** 2).max() <= 1e-13 * want[0] ** 2
    return sigma, want


def test_solver_on_clustered_graded_and_singular_matrices():
    rng = np.random.default_rng(4)
    for d in (1, 2, 3, 17, 64):
        sigma, want = solved(rng.normal(size=(200, d)))
        assert np.abs(sigma / want - 1).max() < 1e-12
    q = np.linalg.qr(rng.normal(size=(200, 30)))[0]
    turn = np.linalg.qr(rng.normal(size=(30, 30)))[0]
    sigma, _ = solved(q * 10.0 ** -np.arange(0, 15, 0.5))
    assert np.abs(sigma / 10.0 ** -np.arange(0, 15, 0.5) - 1).max() < 1e-10  # also the smallest, relative to itself
    for values in ([1.0] * 30, [1.0] * 10 + [1 + 1e-9] * 10 + [0.5] * 10, [1.0] * 29 + [1e-9], [2.0] * 3 + [0.0] * 27):
        solved((q * values) @ turn)
        solved(q * values)
    solved(np.repeat(rng.normal(size=(40, 5)), 6, axis=1))
    solved(np.vstack([np.eye(30)] * 3))


def test_smallest_bidiagonal_values_are_accurate_to_themselves():
    # a product of bidiagonal factors with tiny values: an algorithm that forms squares loses them
    n = 20
    a, b = np.full(n, 1.0), np.full(n - 1, 1e4)
    got = whitening.singular_values(a, b)
    assert abs(np.prod(got / 1e4 ** ((n - 1) / n)) * 1e4 ** (n - 1) - 1.0) < 1e-6  # the determinant is 1
    assert got[-1] < 1e-70


def plain_whitening(vectors, components):
    x = np.floor(64 * np.array(vectors, np.float32).astype(float)).astype(np.int64) + 1_000_000
    n, sums = len(x), x.sum(axis=0)
    centred = (n * x - sums) / n
    values, v = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)[:components]
    return n, ((n * x - sums) ** 2).sum(axis=1), centred @ v[:, order] / np.sqrt(values[order]), values[order] / values.sum()


def agrees(got, ids, vectors, components):
    n, deviation, want, explained = plain_whitening(vectors, components)
    assert set(got.n) == {n} and got.identity_error.nunique() == 1 and got.identity_error.max() < 1e-9
    rows = got.pivot(index="vec_id", columns="component", values="whitened").loc[ids].to_numpy()
    signs = np.sign((rows * want).sum(axis=0))
    assert np.abs(rows * signs - want).max() < 1e-8
    assert (got.groupby("vec_id").deviation.first().loc[ids].to_numpy() == deviation).all()
    assert np.abs(got.groupby("component").explained.first().to_numpy() / explained - 1).max() < 1e-9


@pytest.mark.parametrize("dims, components, partitions", [(5, 32, 1), (40, 32, 40), (40, 3, 7)])
def test_whitening(spark, dims, components, partitions):
    rng = np.random.default_rng(dims)
    good = (rng.normal(size=(300, dims)) * np.linspace(1, 9, dims)).astype(np.float32).tolist()
    bad = [None, [], [None] * dims, [float("nan")] * dims, [*good[0][:-1], float("inf")], [*good[0][:-1], None], [float("-inf")] + good[1][1:]]
    rows = [(i, v) for i, v in enumerate(good)] + [(1000 + i, v) for i, v in enumerate(bad)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").repartition(partitions).withColumns({c: F.lit(0) for c in ("x", "n", "task", "r")})
    got = whitening.whiten(df, components).toPandas()
    assert len(got) == 300 * min(components, dims)
    agrees(got, list(range(300)), good, components)


def test_whitening_of_odd_tables(spark):
    make = lambda rows: spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    assert whitening.whiten(make([])).count() == 0
    assert whitening.whiten(make([(1, None), (2, [float("nan")])])).count() == 0
    assert whitening.whiten(make([(i, [1.0, 2.0]) for i in range(5)])).count() == 0  # equal rows vary in no direction
    with pytest.raises(ValueError, match="entries"):
        whitening.whiten(make([(1, [1.0]), (2, [1.0, 2.0])]))
    # repeated and null ids are rows like others; the second direction is a copy of the first
    rows = [(None, [0.0, 0.0]), (1, [1.0, 1.0]), (1, [3.0, 3.0]), (2, [-4.0, -4.0])]
    got = whitening.whiten(make(rows)).toPandas()
    assert len(got) == 4 and got.identity_error.max() < 1e-12 and got.vec_id.isna().sum() == 1 and abs(got.explained - 1).max() < 1e-12


def test_op12_on_the_table(spark):
    table = spark.read.parquet(f"{FOLDER}/embeddings.parquet").toPandas().sort_values("vec_id")
    agrees(queries.op12_whitening(spark, FOLDER).toPandas(), list(table.vec_id), table.embedding.tolist(), 32)


# chunked BPE


def plain_digest(texts):
    whole = Tokenizer.from_file(BYTE_LEVEL)
    out = []
    for i, t in texts:
        ids = whole.encode(t or "", add_special_tokens=False).ids
        back = whole.decode(ids, skip_special_tokens=False)
        out.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("bits", [26, 6])
def test_chunked_bpe(spark, monkeypatch, bits):
    monkeypatch.setattr(chunked_bpe, "FILTER_BITS", bits)  # 6: the filter is full and lets every chunk through
    docs, rows = as_documents(spark, some_texts(5))
    got = sorted((tuple(r) for r in chunked_bpe.bpe_digest(docs, BYTE_LEVEL).collect()), key=repr)
    assert got == plain_digest(rows)
    texts = chunked_bpe.decode_documents(chunked_bpe.encode_documents(docs, BYTE_LEVEL), BYTE_LEVEL)
    assert sorted(((r.doc_id, r.text) for r in texts.collect()), key=repr) == sorted(((i, t or "") for i, t in rows), key=repr)
    assert chunked_bpe.bpe_digest(docs.limit(0), BYTE_LEVEL).count() == 0


def test_op13_on_the_table(spark):
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    got = queries.op13_bpe(spark, FOLDER).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain_digest(texts)


def test_shared_passages_are_encoded_once(spark):
    rng = random.Random(11)
    passage = " ".join(f"word{rng.randrange(10**6)}" for _ in range(900))
    own = lambda n: " ".join(str(rng.random()) for _ in range(n))
    docs = spark.createDataFrame([(i, f"{own(50)} {passage} {own(30)}") for i in range(12)], "doc_id bigint, text string")
    bits = spark.sparkContext.broadcast(chunked_bpe.repeated_filter(docs))
    once = chunked_bpe.encode_repeated(docs, BYTE_LEVEL, bits).toPandas()
    assert once.chunk.is_unique and len(once) > 3
    back = chunked_bpe.Joiner.of(BYTE_LEVEL)
    shared = [back.decode(np.frombuffer(i, "<u2")).decode() for i in once.ids]
    assert all(s in passage for s in shared) and sum(map(len, shared)) > 0.6 * len(passage)


def test_cuts_follow_the_content():
    rng = random.Random(2)
    passage = "".join(rng.choice("abcdé 中\n") for _ in range(6000)).encode()
    here, there = (set(chunked_bpe._pieces(p + passage)) for p in (b"", b"something in front " * 40))
    assert len(here & there) >= 0.7 * len(here)
    for raw in (b"", b"a", passage, "é".encode() * 9000, b"x" * 20000, "中".encode() * 3000):
        pieces = chunked_bpe._pieces(raw)
        assert b"".join(pieces) == raw and all(p.decode() for p in pieces) and all(len(p) <= chunked_bpe.MOST + 3 for p in pieces)


def test_joins_at_any_place_agree_with_the_whole():
    whole, joiner, rng = Tokenizer.from_file(BYTE_LEVEL), chunked_bpe.Joiner.of(BYTE_LEVEL), random.Random(8)
    bits = ["a", "Z", "é", "1", "'", "'s", "'re", " ", "  ", "\n", "\t", "\x85", "\xa0", "\x1c", ".", "<|", "|>", "<|endoftext|>", "the", " and", "́", "中文", "😀", " ", "　"]
    for _ in range(3000):
        parts = ["".join(rng.choice(bits) for _ in range(rng.randint(1, 12))).encode() for _ in range(rng.randint(1, 6))]
        got = joiner.join([(p, joiner.ids(p)) for p in parts])
        assert got.tolist() == whole.encode(b"".join(parts).decode(), add_special_tokens=False).ids, parts


@pytest.mark.parametrize("path", [WORD_END, BYTE_LEVEL])
def test_runs_are_what_the_library_gives(path):
    whole, pieces, rng = Tokenizer.from_file(path), WordPieces.of(path), random.Random(9)
    bits = ["a", "Z", "é", "ß", "İ", "ı", "µ", "²", "½", "1", "'S", "'re", " ", "\n", "\x85", "\xa0", "\x1c", "\x00", ".", "_", "<|", "|>", "the"]
    bits += ["<|endoftext|>", "<|ENDOFTEXT|>", "<|StartOfText|>", "é", "Σ", "中文", "\xad", "﻿", "٣", "ĭ", "Å"]
    for _ in range(4000):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(0, 12)))
        assert np.frombuffer(pieces.encode(text), "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids, repr(text)
