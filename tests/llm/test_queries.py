"""Registered queries against their SQL or a plain version on the smallest tables; the pipeline stage by stage."""

import zlib

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from tests.llm.test_operators import VOCABULARY, encoded, plain_fingerprint, roots_of
from wagerlens.llm import queries

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_agrees_with_sql(spark, name):
    db = duckdb.connect()
    for table in ("documents", "pages", "benchmark"):
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    got = queries.QUERIES[name](spark, FOLDER).toPandas()
    want = db.execute(queries.ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    columns = sorted(got.columns)
    norm = lambda df: sorted(tuple(None if x is None or x != x else x for x in r) for r in df[columns].astype(object).itertuples(index=False))
    assert sorted(map(repr, norm(got))) == sorted(map(repr, norm(want)))


def test_op5(spark, texts):
    got = queries.op5_token_files(spark, FOLDER).orderBy("doc_id").collect()
    start = 0
    for r in got:
        ids = encoded(texts[r.doc_id], 2)
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids) // 4, zlib.crc32(ids))
        start += r.n_tokens


def test_op7(spark, texts):
    got = queries.op7_packing(spark, FOLDER).collect()
    assert {r.doc_id for r in got} == set(texts)
    assert sum(r.length for r in got) == sum(len(encoded(t, 1)) // 4 for t in texts.values())


def test_op8(spark, texts):
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in queries.op8_simhash(spark, FOLDER).collect()}
    fps = {i: plain_fingerprint(t, 3) for i, t in texts.items()}
    roots = roots_of(set(fps.values()), [(a, b) for a in set(fps.values()) for b in set(fps.values()) if a < b and (a ^ b).bit_count() <= 2])
    least = {}
    for i, f in fps.items():
        least[roots[f]] = min(least.get(roots[f], i), i)
    assert got == {i: (f"{f:016x}", least[roots[f]]) for i, f in fps.items()}


def test_classifiers_and_model_cover_every_document(spark, texts):
    for name in ("op3_quality", "op4_toxicity", "op6_language_model", "op9_order_minhash", "op10_mixing"):
        got = queries.QUERIES[name](spark, FOLDER).toPandas()
        assert sorted(got.doc_id) == sorted(texts), name
        if "score" in got and "predicted" in got:
            assert ((got.score >= 0.3).astype(int) == got.predicted).all() and got.score.between(0, 1).all()


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet").toPandas().set_index("doc_id")
    for name, label, least in (("op3_quality", "quality", 0.95), ("op4_toxicity", "toxic", 0.85)):
        got = queries.QUERIES[name](spark, folder).toPandas().set_index("doc_id").join(labels, how="inner")
        held = got[got.held_out]
        assert (held.predicted == held[label]).mean() >= least, name


def test_pipeline(spark, texts):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    before = set(texts)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = corpus_pipeline.materialize(stage(spark, docs, FOLDER), f"test-{name}")
        assert after.columns == docs.columns
        ids = {r.doc_id for r in after.select("doc_id").collect()}
        assert ids <= before, name
        if name == "exact_duplicates":
            assert ids == {max(j for j in before if texts[j] == texts[i]) for i in before}
        if name == "near_duplicates":
            fps = {i: plain_fingerprint(texts[i], 3) for i in before}
            some = sorted(set(fps.values()))
            roots = roots_of(some, [(a, b) for i, b in enumerate(some) for a in some[:i] if (a ^ b).bit_count() <= 2])
            assert ids == {min(j for j in before if roots[fps[j]] == root) for root in {roots[f] for f in fps.values()}}
        before, docs = ids, after
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").toPandas().set_index("doc_id")
    assert not any(labels.quality.get(i) == 0 for i in before)
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).collect()
    assert {r.doc_id for r in packed} == before
    assert np.max([r.offset + r.length for r in packed]) <= 4096 and VOCABULARY
