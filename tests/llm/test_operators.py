"""Each operator against a plain version on small tables that hold nulls, empty and long texts, ties and repeated rows."""

import hashlib
import random
import re
import string
import zlib

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F

from wagerlens.llm import exact_dedup as ed
from wagerlens.llm import language_model as lm
from wagerlens.llm import mixing, order_minhash, packing, quality, simhash, token_files, toxicity, url_rules
from wagerlens.llm.common import WordPieces, connected_components, id_crc

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
CLASHES = ["digest", "keep_id", "score", "fp", "key", "range", "piece", "label", "rate", "__rate", "soft", "text_sha256", "row", "shard"]


def words(rng, n):
    return " ".join(rng.choice("the of lorem ipsum dolor sit amet stone river cloud seven lamp".split()) + rng.choice(["", "", "er", "ing"]) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    texts = [words(rng, rng.randint(3, 60)) for _ in range(40)]
    texts += [texts[0]] * 6 + [texts[1]] * 2 + [None, "", "", " \n", "one", "One", "ÉCOLE l'été 12.5!", "<|endoftext|> x"]
    texts += [words(rng, 9000), texts[3] + " more", "same " * 700]
    out = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
    return out + [out[2], out[2], (None, texts[4], None, None, None), (None, "nobody's", None, None, None)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    """With columns that operators use for themselves."""
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return df.withColumns({c: F.lit("clash") for c in CLASHES})


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame(
        [(i, int(i % 3 > 0), int(i % 4 == 0)) for i in range(30)] + [(None, 1, 1), (31, None, None), (5, 1, 1)], "doc_id bigint, quality int, toxic int"
    )


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# exact dedup


def plain_dedup(rows, largest):
    groups = {}
    for i, t, *_ in rows:
        groups.setdefault(t or "", []).append(i)
    out = []
    for i, t, *_ in rows:
        ids = [x for x in groups[t or ""] if x is not None]
        keep = (max(ids) if largest else min(ids)) if ids else None
        out.append((i, keep, len(groups[t or ""]), i == keep, hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("digest", [ed.md5_128, lambda t: F.length(t) % 3])
@pytest.mark.parametrize("keep", ["largest", "smallest"])
def test_exact_dedup(docs, rows, keep, digest):
    # the second digest is shared by many texts: their bytes must tell them apart
    assert collected(ed.exact_dedup(docs, keep, digest)) == plain_dedup(rows, keep == "largest")


def test_drop_exact(docs, rows):
    kept = ed.drop_exact(docs, "largest")
    assert kept.columns == docs.columns
    got = kept.collect()
    assert sorted(r.text or "" for r in got) == sorted({t or "" for _, t, *_ in rows})
    want = {t: k for i, k, n, kept_, sha in plain_dedup(rows, True) for t in [sha]}
    assert all(want[hashlib.sha256((r.text or "").encode()).hexdigest()] == r.doc_id for r in got)


# url rules


def plain_judge(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host, rest = "".join(c.lower() if c.isascii() else c for c in rest[:cut]), rest[cut:]
    path = rest[: min([rest.find(c) for c in "?#" if c in rest] or [len(rest)])]
    best = None
    for verdict, rule in rules:
        at = rule.find("/") if "/" in rule else len(rule)
        h, p = rule[:at].lower(), rule[at:]
        if (host == h or host.endswith("." + h)) and path.startswith(p):
            found = (len(h) + len(p), len(h), h + p, verdict)
            best = max(best or found, found)
    return (host, path, *((best[2], best[3]) if best else (None, "allow")))


def test_url_rules(spark):
    rng = random.Random(7)
    hosts = ["org", "Example.org", "a.example.org", "b.a.example.org", "notexample.org", "example.com", "x.com", "com", "éx.com", "a..org", "org:80"]
    paths = ["", "/", "/es/", "/es/x", "/en/1", "/en/12/3", "/fr/", "/de/x", "/es", "/%_", "//es/"]
    urls = [f"{rng.choice(['http', 'HTTPS'])}://{h}{p}{t}" for h in hosts for p in paths for t in ("", "?q=/es/", "#en")] * 2
    urls += [None, "", "no scheme/es/", "://", "http://", "x://a.example.org", "http://a://org/es/"] + ["http://hot.example.org/es/1"] * 50
    rules = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"),
             ("block", "a.example.org"), ("allow", "a.example.org/es/x"), ("allow", "Example.org/en/12"), ("block", "com/fr/"), ("block", "com/fr/")]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string").withColumn("host", F.lit("clash"))
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_rules.judge_urls(pages, url_rules.rule_table(spark, rules)).collect()}
    rules = [r for r in rules if r != ("allow", "com/fr/")]  # where rules disagree, block wins
    assert got == {i: plain_judge(u, rules) for i, u in enumerate(urls)}
    none = url_rules.judge_urls(pages.limit(0), url_rules.rule_table(spark, rules))
    assert none.count() == 0
    assert {r.rule for r in url_rules.judge_urls(pages, spark.createDataFrame([], "verdict string, rule string")).collect()} == {None}


# classifiers


def test_trees_learn_a_rule_that_is_not_linear():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3000, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 2] > 0.3)).astype(float)
    trees = quality.boost(x[:2000], y[:2000])
    assert ((trees.score(x[2000:]) > 0.5) == y[2000:]).mean() > 0.95


def test_trees_walk_like_one_row_at_a_time():
    rng = np.random.default_rng(2)
    x, y = rng.normal(size=(300, 3)), rng.integers(0, 2, 300)
    trees = quality.boost(x, y, trees=5, depth=3)
    for row, score in zip(x[:50], trees.score(x[:50])):
        total = trees.base
        for f, t, leaf in zip(trees.feature, trees.threshold, trees.leaf):
            at = 0
            while at < len(f):
                at = 2 * at + 1 + int(row[f[at]] > t[at])
            total += leaf[at - len(f)]
        assert score == pytest.approx(1 / (1 + np.exp(-total)))


def test_quality_scores_every_row(docs, labels, empty, rows):
    scored = quality.score_quality(docs, labels)
    assert scored.count() == len(rows)
    assert scored.where("score between 0 and 1").count() == len(rows)
    assert quality.score_quality(empty, labels).count() == 0
    assert quality.score_quality(docs, labels.limit(0)).select("score").distinct().count() == 1
    assert quality.keep_good(docs, labels, at_least=0.0).columns == docs.columns


def test_nearest_examples_are_exact():
    rng = np.random.default_rng(3)
    terms, n = 30, 500
    at = [np.sort(rng.choice(terms, rng.integers(0, 5), replace=False)) for _ in range(n)]
    tf = [rng.integers(1, 4, len(a)) for a in at]
    idf = rng.uniform(1, 5, terms)
    index = toxicity.Index.build(list(range(n)), rng.integers(0, 2, n).tolist(), at, tf, idf)
    whole = np.zeros((n, terms))
    for i, (a, f) in enumerate(zip(at, tf)):
        if len(a):
            whole[i, a] = toxicity.unit(a, f.astype(float), idf)
    for a, f in zip(at[:100], tf[:100]):
        if len(a):
            q = toxicity.unit(a, f.astype(float), idf)
            sims = np.round(whole[:, a] @ q, 9)
            want = np.lexsort((np.arange(n), -sims))
            want = want[(sims[want] >= sims[want[14]]) & (sims[want] > 0)]  # as near as the 15th
            got, cosines = index.nearest(a, q, 15)
            assert cosines == pytest.approx(sims[want], abs=1e-9)
            assert got.tolist() == want.tolist()


def test_ids_take_no_part_in_a_vote():
    """Forty equally near examples, of two kinds in any order of ids: the score is that of their shares."""
    rng = np.random.default_rng(4)
    scores = []
    for _ in range(5):
        y = rng.permutation([1] * 10 + [0] * 30)
        index = toxicity.Index.build(list(range(40)), y.tolist(), [[0]] * 40, [[1]] * 40, np.ones(1))
        score, ids, cosines = index.vote(np.array([0]), np.array([2.0]), 15, 0.5)
        assert len(ids) == len(cosines) == 15
        scores.append(score)
    assert scores == pytest.approx([(15 * 10 / 40 + 0.5 * 10.5 / 41) / 15.5] * 5)


def test_scores_are_those_of_every_example_compared(spark):
    """Chosen terms, rareness over all documents, cosines, votes: all from the definitions, without an index."""
    rng = random.Random(21)
    texts = [words(rng, rng.randint(5, 40)) + rng.choice(["", "", " scum", " filth scum", " filth", " scum scum"]) for _ in range(300)]
    toxic = [int("scum" in t or "filth" in t) if rng.random() > 0.1 else 0 for t in texts]
    known = spark.createDataFrame([(i, toxic[i]) for i in range(200)], "doc_id bigint, toxic int")
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    chosen = toxicity.choose_terms(spark.createDataFrame([(texts[i], toxic[i]) for i in range(200)], "text string, label int"))
    assert set(chosen) >= {"scum"}
    held = [toxicity.words_and_stems(t) for t in texts]
    idf = {w: np.log((1 + 300) / (1 + sum(w in h for h in held))) + 1 for w in chosen}

    def vector(h):
        v = np.array([(1 + np.log(h[w])) * idf[w] if w in h else 0.0 for w in chosen])
        return v / max(np.sqrt(v @ v), 1e-300)

    v, y = [vector(h) for h in held], np.array(toxic[:200], float)
    prior, bare = (y.sum() + 0.5) / 201, [i for i in range(200) if not v[i].any()]
    for r in toxicity.score_toxicity(docs, known).collect():
        sims = np.round([v[r.doc_id] @ v[i] for i in range(200)], 9)
        if not v[r.doc_id].any():
            want = (y[bare].sum() + prior) / (len(bare) + 1)
        else:
            last = np.sort(sims)[-15]
            share = np.where(sims > last, 1.0, np.where(sims == last, (15 - (sims > last).sum()) / (sims == last).sum(), 0.0))
            votes = sims**2 * share
            want = (votes @ y + 0.5 * prior) / (votes.sum() + 0.5)
        assert r.score == pytest.approx(want, abs=1e-6)


def test_toxicity_finds_marked_texts(spark, docs, labels, empty, rows):
    rng = random.Random(9)
    texts = [(i, words(rng, 30) + (" scum " if i % 4 == 0 else " ") + words(rng, 20)) for i in range(400)] + [(900, None), (901, "")]
    known = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(200)], "doc_id bigint, toxic int")
    got = {r.doc_id: r for r in toxicity.score_toxicity(spark.createDataFrame(texts, "doc_id bigint, text string"), known).collect()}
    assert all((got[i].score > 0.5) == (i % 4 == 0) for i in range(200, 400))
    assert 0 < got[900].score == got[901].score < 0.3 and got[900].neighbours == []
    assert {n.doc_id % 4 for n in got[204].neighbours} == {0}
    assert toxicity.score_toxicity(docs, labels).count() == len(rows)
    assert toxicity.score_toxicity(empty, labels).count() == 0
    assert toxicity.score_toxicity(docs, labels.limit(0)).select("score").distinct().count() == 1


def test_terms_by_chance_and_copies_do_not_tell(spark):
    rng = random.Random(11)
    texts = [(" ".join(f"w{chr(97 + rng.randrange(26))}{chr(97 + rng.randrange(26))}" for _ in range(60)) + (" scum" if i % 5 == 0 else ""), int(i % 5 == 0)) for i in range(300)]
    texts += [("only copies say marvel", 1)] * 200
    assert toxicity.choose_terms(spark.createDataFrame(texts, "text string, label int")) == ["scum"]


# token files, packing


def encoded(text, end):
    return np.array([*WordPieces.of(VOCABULARY)._tokenizer.encode(text or "", add_special_tokens=False).ids, end], "<u4").tobytes()


@pytest.mark.parametrize("seed", range(3))
def test_words_in_a_row_are_the_text(seed):
    rng = random.Random(seed)
    for _ in range(400):
        text = "".join(rng.choice("aAbBéÉßİΣσς.,!?'s ’0\n\t\u0301\xa0łſK<|>_") for _ in range(rng.randint(0, 40)))
        assert WordPieces.of(VOCABULARY).encode(text) == encoded(text, 0)[:-4]


def test_token_files_round_trip(spark, docs, rows, empty, tmp_path):
    token_files.write_tokens(docs, f"{tmp_path}/t", VOCABULARY, 2)
    got = token_files.read_tokens(spark, f"{tmp_path}/t").orderBy("start").collect()
    order = [r.doc_id for r in got]
    assert order == sorted(order, key=lambda i: (i is not None, i or 0))
    assert [r.start for r in got] == np.concatenate([[0], np.cumsum([r.n_tokens for r in got])[:-1]]).tolist()
    want = sorted(((i, encoded(t, 2)) for i, t, *_ in rows), key=repr)
    assert sorted(((r.doc_id, bytes(r.ids)) for r in got), key=repr) == want
    one = token_files.read_document(spark, f"{tmp_path}/t", 7).collect()
    assert [r.n_tokens for r in one] == [len(encoded(rows[7][1], 2)) // 4]
    assert token_files.token_digest(empty, VOCABULARY, 2).count() == 0


def test_fullest_is_the_best_sum():
    rng = random.Random(4)
    for _ in range(200):
        limit = rng.randint(5, 40)
        counts = {rng.randint(1, limit): rng.randint(1, 4) for _ in range(rng.randint(1, 6))}
        chosen = packing.fullest(counts, limit)
        sums = {0}
        first = max(counts)
        for k, n in counts.items():
            for _ in range(n - (k == first)):
                sums |= {s + k for s in sums}
        assert all(chosen[k] <= counts[k] for k in chosen) and chosen[first] >= 1
        assert sum(k * n for k, n in chosen.items()) == first + max(s for s in sums if s <= limit - first)


def test_packing_places_every_token_once(docs, rows, empty):
    got = packing.pack(docs, VOCABULARY, 1, 256).collect()
    want = []
    for i, t, *_ in rows:
        ids = encoded(t, 1)
        want += [(i, p, p * 256, len(ids[at : at + 1024]) // 4, zlib.crc32(ids[at : at + 1024])) for p, at in enumerate(range(0, len(ids), 1024))]
    assert sorted((tuple(r)[:5] for r in got), key=repr) == sorted(want, key=repr)
    bins = {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for held in bins.values():
        end = 0
        for offset, length in sorted(held):
            assert offset == end
            end += length
        assert end <= 256
    assert len(bins) <= -(-sum(r.length for r in got) // 256) * 1.1 + 1
    assert packing.pack(empty, VOCABULARY, 1).count() == 0


# language model


def test_base_score_is_exact_and_filter_never_low(spark, docs, rows, empty):
    settings = {"bits": 1 << 20, "common": 20}  # few common words: the others are joined
    got = {(r.doc_id, r.n_tokens): r for r in lm.score_texts(docs, **settings).collect()}
    trained = [lm.tokens(t or "") + [b"<end>"] for i, t, *_ in rows if zlib.crc32(str("" if i is None else i).encode()) % 10]
    counts = {}
    for line in trained:
        for w in line:
            counts[w] = counts.get(w, 0) + 1
    total, distinct = sum(counts.values()), len(counts)
    for i, t, *_ in rows:
        line = lm.tokens(t or "") + [b"<end>"]
        r = got[i, len(line)]
        assert r.train_tokens == total and r.n_known == sum(w in counts for w in line)
        assert r.base_score == pytest.approx(sum(np.log10((counts.get(w, 0) + 0.1) / (total + 0.1 * (distinct + 1))) for w in line))
        assert r.held_out == (zlib.crc32(str("" if i is None else i).encode()) % 10 == 0) and r.score < 0
    assert lm.score_texts(empty, bits=1 << 20).count() == 0
    model, _ = lm.fit(docs.limit(0).select("text"), bits=1 << 20)
    assert model.total == 0


def test_filter_tells_levels():
    rng = np.random.default_rng(5)
    grams, levels = rng.integers(0, 2**63, 3000).astype(np.uint64) * np.uint64(2), rng.integers(1, 12, 3000)
    per = 1 << 10
    held = np.zeros((lm.SEGMENTS, per), np.uint8)
    for g, q in zip(grams, levels):
        for level in range(1, q + 1):
            for at in lm.positions(np.array([g]), level, 8, np.uint64(per - 1)):
                held[int(g >> np.uint64(54)), int(at(np.array([0]))[0])] = 1
    found = lm.Filter(np.packbits(held, axis=1, bitorder="little"), 8).levels(grams)
    assert (found >= levels).all() and (found == levels).mean() > 0.99
    assert lm.cutoff([(1, 50), (2, 30), (3, 10)], 100) == 1 and lm.cutoff([(1, 50), (2, 30), (3, 10)], 40) == 2


def test_no_ngram_is_cut_however_small_a_segment(spark, monkeypatch):
    """In 4096 bits of filter, and no more, most levels found no place."""
    monkeypatch.setattr(lm, "_PART", 1 << 12)
    rng = random.Random(12)
    texts = [" ".join(f"w{int(rng.expovariate(0.02))}" for _ in range(rng.randint(1, 80))) for _ in range(300)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string").repartition(2)
    small, large = ({r.doc_id: r.score for r in lm.score_texts(df, bits=bits, probes=16).collect()} for bits in (1 << 12, 1 << 29))
    assert [small[i] for i in range(300)] == pytest.approx([large[i] for i in range(300)], rel=0.01)


def plain_scores(texts, train, weight=0.3):
    """The model's scores with levels told without a filter."""
    lines = [[b" start", *lm.tokens(t), b" end"] for t in texts]
    counts, pairs = {}, {}
    for line in (x for x, t in zip(lines, train) if t):
        for a, b in zip(line, line[1:]):
            counts[b] = counts.get(b, 0) + 1
            pairs[a, b] = pairs.get((a, b), 0) + 1
    told = lambda n: float(lm.middle(lm.level_of(np.array([n])))[0])
    all_told = sum(map(told, counts.values()))
    out = []
    for line in lines:
        total = 0
        for a, b in zip(line, line[1:]):
            both, before = told(pairs.get((a, b), 0)), sum(train) if a == b" start" else told(counts.get(a, 0))
            total += np.log10((1 - weight) * (told(counts.get(b, 0)) + 0.1) / (all_told + 0.1 * (len(counts) + 1)) + weight * both / max(before, both, 1))
        out.append(total)
    return out


def test_bigrams_met_once_and_starts_count(spark):
    rng = random.Random(12)
    texts = [" ".join(f"w{int(rng.expovariate(0.02))}" for _ in range(rng.randint(1, 80))) for _ in range(300)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string").repartition(2)
    got = {r.doc_id: r.score for r in lm.score_texts(df, F.col("doc_id") % 5 > 0, probes=16).collect()}
    assert [got[i] for i in range(300)] == pytest.approx(plain_scores(texts, [i % 5 > 0 for i in range(300)]), rel=0.01)


# near-duplicates


def plain_fingerprint(text, width):
    w = (text or "").encode().lower().split()
    shingles = [b" ".join(w[i : i + width]) for i in range(max(1, len(w) - width + 1))] if w else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots_of(nodes, linked):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in linked:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_fingerprints(docs, rows):
    got = sorted(((r.doc_id, r.fp % 2**64) for r in simhash.fingerprints(docs).collect()), key=repr)
    assert got == sorted(((i, plain_fingerprint(t, 3)) for i, t, *_ in rows), key=repr)


@pytest.mark.parametrize("crowd", [3, 64])
def test_links_have_the_components_of_all_pairs(spark, monkeypatch, crowd):
    monkeypatch.setattr(simhash, "CROWD", crowd)  # below it pairs, above it meetings
    rng = random.Random(6)
    seeds = [rng.getrandbits(64) for _ in range(12)]
    fps = {s ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))) for s in seeds for _ in range(40)} | {0, 3, 2**64 - 1}
    signed = {f: f - (1 << 64) if f >> 63 else f for f in fps}
    linked = simhash.linked(spark.createDataFrame([(v,) for v in signed.values()], "fp long"))
    got = {r.node: r.root for r in connected_components(linked).collect()}
    some = sorted(fps)
    want = roots_of(signed.values(), [(signed[a], signed[b]) for i, a in enumerate(some) for b in some[:i] if (a ^ b).bit_count() <= 2])
    assert {v: got.get(v, v) for v in signed.values()} == want


def test_references_discard_far_pairs_and_no_near_one(spark):
    rng = random.Random(16)
    signed = lambda f: f - (1 << 64) if f >> 63 else f
    seeds = [rng.getrandbits(64) for _ in range(200)]
    flipped = lambda f, n: f ^ sum(1 << b for b in rng.sample(range(64), n))
    near, far, any_two = ([(signed(s), signed(flipped(s, n))) for s in seeds] for n in (2, 8, 32))
    told = {}
    for name, pairs in (("near", near), ("far", far), ("any", any_two)):
        told[name] = {r.reference: r.share for r in simhash.discarded(spark.createDataFrame(pairs, "a long, b long")).collect()}
    refs = simhash._references()
    assert all((a ^ b).bit_count() in (32,) for i, a in enumerate(r % 2**64 for r in refs) for b in [x % 2**64 for x in refs[:i]])
    assert set(told["near"].values()) == {0.0}
    assert all(share > 0.4 for share in told["any"].values()) and told["any"][None] == 1.0
    assert told["far"][None] > 0.95 and told["far"][None] > max(v for k, v in told["far"].items() if k is not None)
    assert {r.share for r in simhash.discarded(spark.createDataFrame([], "a long, b long")).collect()} == {None}


def test_near_groups(docs, rows, empty):
    got = simhash.near_groups(docs).collect()
    fps = {plain_fingerprint(t, 3) for _, t, *_ in rows}
    roots = roots_of(fps, [(a, b) for a in fps for b in fps if a < b and (a ^ b).bit_count() <= 2])
    least = {}
    for i, t, *_ in rows:
        r = roots[plain_fingerprint(t, 3)]
        least[r] = min((x for x in (least.get(r), i) if x is not None), default=None)
    want = sorted(((i, least[roots[plain_fingerprint(t, 3)]]) for i, t, *_ in rows), key=repr)
    assert sorted(((r.doc_id, r.component_id) for r in got), key=repr) == want
    assert simhash.near_groups(empty).count() == 0
    kept = simhash.drop_near(docs)
    assert sorted(r.doc_id for r in kept.where("doc_id is not null").collect()) == sorted({c for _, c in want if c is not None})
    assert kept.columns == docs.columns


def test_rows_that_repeat_the_smallest_id_leave_one_row_whatever_the_order(spark):
    rows = [(1, "a b c d", "x"), (1, "e f g h", "y"), (1, "a b c d", "x"), (2, "a b c d", "z"), (None, "a b c d", "n"), (None, None, "n")]
    left = []
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, "doc_id bigint, text string, __row string").repartition(3)
        left.append(sorted((tuple(r) for r in simhash.drop_near(df).collect()), key=repr))
    assert left[0] == left[1] and [r[0] for r in left[0]].count(1) == 1 and [r[0] for r in left[0]].count(None) == 2


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(1000, 1001), (7, 7)], "a long, b long")
    got = {r.node: r.root for r in connected_components(edges).collect()}
    assert got == {**{i: 0 for i in range(201)}, 1000: 1000, 1001: 1000}


# order minhash


def test_edited_fingerprints(docs, rows, empty):
    got = order_minhash.edited_fingerprints(docs).collect()
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode()))
    want = []
    for (i, t, *_), (_, following, *_) in zip(order, order[1:] + order[:1]):
        t, q = t or "", len(t or "") // 4
        want.append((i, len(t), hashlib.sha256((t[: len(t) - q] + (following or "")[:q]).encode()).hexdigest()))
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in got), key=repr) == sorted(want, key=repr)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    by_text = {}
    for r in got:
        by_text.setdefault((dict((i, t) for i, t, *_ in rows).get(r.doc_id) if r.doc_id is not None else r.n_chars), set()).add(r.fingerprint)
    assert all(len(x) == 1 for x in by_text.values())
    assert order_minhash.edited_fingerprints(empty).count() == 0


def plain_signature(text, sketches=24, tuple_size=2, words=3, characters=5, unspaced=24):
    signed = lambda h: h - (1 << 64) if h >> 63 else h
    units = [u for w in re.split(r"[ \t\n\x0B\f\r]+", text) for u in ([w] if len(w) < unspaced else w)]
    seen, kmers = {}, []
    for i in range(max(len(units) - words + 1, 1)):
        h = 42
        for u in units[i : i + (characters if len(units[i]) == 1 else words)]:
            h = xxhash.xxh64_intdigest(u.encode(), h)
        h >>= 24
        n = seen[h] = seen.get(h, -1) + 1
        if n:
            h = xxhash.xxh64_intdigest((n - 1).to_bytes(4, "little"), xxhash.xxh64_intdigest(h.to_bytes(8, "little"), 42)) >> 24
        kmers.append(((h ^ 1 << 39), i + 1, h))  # as signed numbers are ordered
    out = []
    for i in range(sketches):
        place = ((i << 64) // sketches) >> 24
        first = sorted(kmers, key=lambda k: ((k[0] - place) % (1 << 40), k[1]))[:tuple_size]
        h = 42
        for _, _, x in sorted(first, key=lambda k: k[1]):
            h = xxhash.xxh64_intdigest((x >> 1).to_bytes(8, "little"), h)
        out.append(signed(h))
    return out


def test_fingerprints_and_likeness_are_those_of_all_kmers(docs, rows):
    got = order_minhash.edited_fingerprints(docs).collect()
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode()))
    texts = [r[1] or "" for r in order]
    want = []
    for r, text, after in zip(order, texts, texts[1:] + texts[:1]):
        quarter = len(text) // 4
        own, changed, following = (plain_signature(t) for t in (text, text[: len(text) - quarter] + after[:quarter], after))
        told = ["".join(f"{x % 2**64:016x}" for x in s) for s in (own, changed)]
        share = [sum(a == b for a, b in zip(own, s)) / len(own) for s in (changed, following)]
        want.append((r[0], *told, *share))
    have = [(r.doc_id, r.fingerprint, r.edited_fingerprint, r.near_edited, r.near_next) for r in got]
    assert sorted(have, key=repr) == sorted(want, key=repr)


def test_every_kmer_can_change_a_fingerprint(spark):
    """Of a long text, however long, the first k-mers from each place count, wherever in the text they are."""
    rng = random.Random(14)
    text = words(rng, 3000) + " again and again and again and again"
    df = spark.createDataFrame([(text,), ("a",), ("",), ("x y",), (" lead",)], "text string")
    got = {r.text: r.s for r in df.select("text", order_minhash.signature(F.col("text"), sketches=64).alias("s")).collect()}
    assert all(s == plain_signature(t, sketches=64) for t, s in got.items())


def test_signature_follows_order(spark):
    rng = random.Random(8)
    base = [f"w{rng.randint(0, 500)}" for _ in range(300)]
    near = base[:]
    near[150] = "other"
    turned = base[150:] + base[:150]
    shuffled = sorted(base)
    df = spark.createDataFrame([(k, " ".join(v)) for k, v in enumerate([base, near, turned, shuffled])], "k int, text string")
    s = {r.k: r.s for r in df.select("k", order_minhash.signature(F.col("text"), sketches=64).alias("s")).collect()}
    like = lambda a, b: np.mean(np.array(s[a]) == np.array(s[b]))
    assert like(0, 1) > 0.8 and like(0, 1) > like(0, 2) > like(0, 3) == 0


def test_repeated_kmers_are_numbered(spark):
    df = spark.createDataFrame([(" ".join(["again"] * n),) for n in (60, 61, 120)], "text string")
    s = [r.s for r in df.select(order_minhash.signature(F.col("text"), sketches=64).alias("s")).collect()]
    assert 0.5 < np.mean(np.array(s[0]) == np.array(s[1])) < 1 and s[0] != s[2]


def test_near_copies_agree_at_any_length_and_without_spaces(spark):
    rng = random.Random(13)
    base = words(rng, 100)[:245].rstrip()
    solid = "".join(chr(rng.randrange(0x4E00, 0x9000)) for _ in range(400))
    pairs = [(base, base + " and some more"), (solid, solid[:150] + "x" + solid[151:]), (solid, "xy" + solid), ("k " + solid, "k " + solid[:300])]
    assert len(base) < 256 <= len(base + " and some more")
    df = spark.createDataFrame([(k, *p) for k, p in enumerate(pairs)], "k int, a string, b string")
    like = order_minhash.likeness(order_minhash.signature(F.col("a"), sketches=64), order_minhash.signature(F.col("b"), sketches=64))
    got = {r.k: r.x for r in df.select("k", like.alias("x")).collect()}
    assert all(got[k] > 0.3 for k in range(len(pairs)))


# mixing


def plain_rates(soft, wanted, most, steps):
    t, p = soft[:, -1], soft[:, :-1]
    r = np.ones(len(t))
    for _ in range(steps):
        r = np.clip(r - p @ ((p.T @ (t * r) - wanted) / (p.T @ t)), 0, np.inf if most is None else most)
    return r


@pytest.mark.parametrize("most", [None, 1.0])
def test_rates_match_least_squares(spark, most):
    rng = np.random.default_rng(7)
    soft = np.concatenate([rng.dirichlet([0.3] * 3, 200), rng.integers(1, 50, (200, 1))], axis=1)
    df = spark.createDataFrame([(i, [float(x) for x in row]) for i, row in enumerate(soft)], "doc_id long, soft array<double>").repartition(3)
    wanted = [0.6 * soft[:, 3].sum(), 0.1 * soft[:, 3].sum(), 0.3 * soft[:, 3].sum()]
    pushes = mixing.fit_rates(df, wanted, most, steps=20, near=0.0)
    got = {r.doc_id: r.rate for r in df.select("doc_id", mixing.stepped(F.lit(1.0), F.col("soft"), pushes, most).alias("rate")).collect()}
    want = plain_rates(soft, np.array(wanted), most, len(pushes))
    assert [got[i] for i in range(200)] == pytest.approx(want.tolist(), abs=1e-6)
    if most is None:
        assert soft[:, :3].T @ (soft[:, 3] * want) == pytest.approx(wanted, rel=0.02)


def plain_features(text, terms):
    """Every number from the text anew."""
    told = [w for w in toxicity.words_and_stems(text) if w in terms]
    more = [np.log1p(len(told)), np.log1p(len(told)), np.log1p(float(bool(told)))]
    data, split, lines = text.encode(), text.split(), [x for x in text.split("\n") if x.strip()]
    if not data:
        return [0.0] * 19 + more
    n, w, k = len(data), max(len(split), 1), max(len(lines), 1)
    upper, digits, spaces = (sum(b in chars for b in data) for chars in (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t\n\v\f\r"))
    marks, signs = sum(b in string.punctuation.encode() for b in data), sum(b in b"#$%&*@^~+=<>" for b in data)
    return [
        np.log1p(len(text)), np.log1p(len(split)), np.log1p(len(lines)), sum(map(len, split)) / w, len(set(split)) / w,
        max(map(split.count, split), default=0) / w, len(set(lines)) / k, np.log1p(n / k), upper / n, digits / n, spaces / n, marks / n,
        data.count(b"!") / w, signs / w, data.count(b"|") / w, sum(b > 127 for b in data) / n, len(zlib.compress(data, 1)) / n,
        sum(x[0].isupper() for x in split) / w, sum(x.rstrip()[-1] in ".!?" for x in lines) / k, *more,
    ]


def test_features_and_tokens_come_from_one_split(rows):
    class Text(str):
        """Counts how often the whole of it is split into words or lower-cased."""

        passes = 0

        def split(self, *by):
            Text.passes += not by
            return super().split(*by)

        def lower(self):
            Text.passes += 1
            return super().lower()

    rng = random.Random(17)
    signs = "aAbZk \n\t\x1c\x85\xa0\u2003\u200b.:'’_-0²!?|#ªéÉßΑΣσς\u212aİı\u0307ʰ中\U0001d400"
    texts = [t or "" for _, t, *_ in rows if len(t or "") < 5000]
    texts += ["ΑΣ ΑΣ.Α ΑΣ' Α", "Stone Riverer_clouds stone2river", *("".join(rng.choices(signs, k=rng.randint(0, 60))) for _ in range(2000))]
    found = sorted({w for t in texts for w in toxicity.words_and_stems(t)})
    terms = dict.fromkeys(rng.sample(found, len(found) // 3) + ["river*", "stone", "ας", "ασ"], 1.0)
    model = mixing.DomainModel(terms, np.zeros(1), np.ones(1), np.ones((23, 3)))
    x, tokens = model.measured(texts)
    assert x.tolist() == [plain_features(t, terms) for t in texts]
    assert tokens.tolist() == [len(t.split()) for t in texts]
    model.posteriors([Text("Stone river, stone!\nclouds"), Text("été 12.5")])
    assert Text.passes == 2  # one for each text


def test_mixing_takes_rows_at_their_rates(docs, labels, rows, empty):
    weights = {"clean": 0.6, "toxic": 0.2, "poor": 0.2}
    rated = mixing.mixing_rates(docs, labels, weights).collect()
    assert len(rated) == len(rows)
    assert all(r.rate >= 0 and r.copies in (int(r.rate), int(r.rate) + 1) for r in rated)
    assert {r.doc_id: r.n_tokens for r in rated if r.doc_id == 2} == {2: len(rows[2][1].split())}
    taken = mixing.mixed(docs, labels, weights)
    assert taken.columns == docs.columns and taken.count() == sum(r.copies for r in rated)
    assert taken.where(" or ".join(f"`{c}` <> 'clash'" for c in CLASHES)).count() == 0  # no column of ours got in
    assert mixing.mixing_rates(empty, labels, weights).count() == 0
    assert mixing.mixed(empty, labels, weights).count() == 0


def test_ids_without_a_value_have_a_crc(spark):
    got = [r.c for r in spark.createDataFrame([(0,), (None,)], "doc_id bigint").select(id_crc().alias("c")).collect()]
    assert sorted(got) == sorted([zlib.crc32(b"0"), zlib.crc32(b"")])
