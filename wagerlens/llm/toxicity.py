"""Toxicity by the nearest labelled examples: exact TF-IDF cosine over a block-max inverted index."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import filterfalse

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wagerlens.llm.common import materialize, whole_text
from wagerlens.llm.quality import LABELLED, labelled_sample

CHANCE = 10.83
"""A term counts as telling if its log-likelihood ratio (G squared) is at least this, one in a thousand by chance, and more the
more terms are tried: at least 2 ln(terms in MET or more texts), where about one term in all would pass by chance."""
MET = 3
STEM = 5
BLOCK = 64
_WORD = re.compile(r"[^\W\d_]+")


def words_and_stems(text: str) -> Counter:
    """Lower-case words of a whole text with their counts; longer ones count under their first letters (`stem*`), too."""
    counted = Counter(_WORD.findall(text.lower()))
    stems: Counter = Counter()
    for word, n in counted.items():
        if len(word) > STEM:
            stems[word[:STEM] + "*"] += n
    counted.update(stems)
    return counted


_ASCII_LETTERS = {c: chr(c).lower() if chr(c).isalpha() else " " for c in range(128)}


def distinct_words(pieces: Iterable[str]) -> set[str]:
    """The different words that `words_and_stems` finds in a text of these white-space separated pieces.

    Neither words nor lower case reach across white space. Within ASCII, letters are told apart by a table.
    """
    joined = " ".join(pieces)
    if joined.isascii():
        return set(joined.translate(_ASCII_LETTERS).split())
    pieces = joined.split(" ")
    found = set(" ".join(filter(str.isascii, pieces)).translate(_ASCII_LETTERS).split())
    found.update(_WORD.findall(" ".join(filterfalse(str.isascii, pieces)).lower()))
    return found


def choose_terms(texts: DataFrame, at_most: int | None = None) -> list[str]:
    """The terms of labelled `texts` (text, label) that tell most about the label: largest log-likelihood ratio towards label 1.

    Each distinct text counts a term once: copies of a text say no more about its terms than one of them.
    Counting is a grouped sum. All terms that tell reach the driver, or `at_most` of them: words of the labelled texts, whose number is bounded.
    """
    texts = materialize(texts.select("text", "label", F.sha2("text", 256).alias("digest")).dropDuplicates(["digest", "label"]), "labelled")
    totals = {r.label: r["count"] for r in texts.groupBy("label").count().collect()}
    ones, zeros = totals.get(1, 0), totals.get(0, 0)
    if not ones or not zeros:
        return []

    def terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: dict[int, Counter] = {0: Counter(), 1: Counter()}
            for text, label in zip(batch.column("text"), batch.column("label").to_pylist()):
                seen[label].update(words_and_stems(text.as_py()).keys())
            names = sorted(seen[0].keys() | seen[1].keys())
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), *(pa.array([seen[k][t] for t in names], pa.int64()) for k in (1, 0))], ["term", "a", "b"]
            )

    counted = texts.select("text", "label").mapInArrow(terms, "term string, a long, b long").groupBy("term").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    counted = materialize(counted, "terms")
    tried = counted.where(F.col("a") + F.col("b") >= MET).count()

    def part(k, n, p):  # k of n, where the share p is expected
        return F.when(k > 0, k * F.log(k / (n * p))).otherwise(0.0) + F.when(k < n, (n - k) * F.log((n - k) / (n * (1 - p)))).otherwise(0.0)

    share = (F.col("a") + F.col("b")) / float(ones + zeros)
    tells = part(F.col("a"), F.lit(float(ones)), share) + part(F.col("b"), F.lit(float(zeros)), share)
    told = counted.where(F.col("a") * zeros > F.col("b") * ones).where((F.col("a") + F.col("b")) < ones + zeros)
    told = told.where(2 * tells >= max(CHANCE, 2 * math.log(max(tried, 1))))
    ranked = told.orderBy(tells.desc(), "term").select("term")
    return [r.term for r in (ranked if at_most is None else ranked.limit(at_most)).collect()]


def vectors(docs: DataFrame, terms: list[str]) -> DataFrame:
    """`docs` with their counts of `terms` as two arrays, at and tf, in place of the text."""
    place = {t: i for i, t in enumerate(terms)}
    others = [c for c in docs.columns if c != "text"]
    # which stems can matter is known from the terms; the rest of a text is only split
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, tf = [], []
            for text in batch.column("text"):
                found: Counter = Counter()
                for word, n in Counter(_WORD.findall(text.as_py().lower())).items():
                    if word in place:
                        found[place[word]] += n
                    if len(word) > STEM and (stem := word[:STEM] + "*") in place:
                        found[place[stem]] += n
                pairs = sorted(found.items())
                at.append([p for p, _ in pairs])
                tf.append([n for _, n in pairs])
            kept = [batch.column(c) for c in others]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(at, pa.list_(pa.int32())), pa.array(tf, pa.list_(pa.int32()))], [*others, "at", "tf"])

    schema = ", ".join(f"{c} {docs.schema[c].dataType.simpleString()}" for c in others)
    return docs.mapInArrow(count, f"{schema}, at array<int>, tf array<int>")


def _spans(first: np.ndarray, many: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, ... `many[0]` of them, then those of the next."""
    return np.repeat(first - many.cumsum() + many, many) + np.arange(many.sum())


@dataclass(frozen=True)
class Index:
    """Labelled examples, by ascending id, as postings: for a term the examples that hold it, in blocks of BLOCK examples.

    examples and weights: the postings, by term; entries, one for each block that holds a term: its place among the blocks, where
    its postings begin, the largest of their weights. first[t]: where term t's entries begin.
    """

    idf: np.ndarray
    labels: np.ndarray
    ids: np.ndarray
    examples: np.ndarray
    weights: np.ndarray
    first: np.ndarray
    place: np.ndarray
    begin: np.ndarray
    most: np.ndarray
    prior: float  # share of label 1 among all examples
    blank: float  # among those that hold no term

    @classmethod
    def build(cls, ids: list[int], labels: list[int], at: list, tf: list, idf: np.ndarray) -> "Index":
        order = np.argsort(np.array(ids, np.int64), kind="stable")
        n, terms = len(order), len(idf)
        y = np.array(labels, np.float64)[order] if n else np.zeros(0)
        rows, cols, vals = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]
        blank = np.ones(n, bool)
        for new, old in enumerate(order):
            if len(at[old]):
                t = np.array(at[old], np.int64)
                rows.append(np.full(len(t), new)), cols.append(t), vals.append(unit(t, np.array(tf[old], np.float64), idf))
                blank[new] = False
        rows, cols, vals = map(np.concatenate, (rows, cols, vals))
        by = np.lexsort((rows, cols))
        rows, cols, vals = rows[by], cols[by], vals[by]
        begin = np.unique(cols * (n // BLOCK + 1) + rows // BLOCK, return_index=True)[1]
        most = np.maximum.reduceat(vals, begin) if len(begin) else np.zeros(0)
        prior = (y.sum() + 0.5) / (n + 1)
        return cls(
            idf, y, np.array(ids, np.int64)[order], rows, vals, np.searchsorted(cols[begin], np.arange(terms + 1)), rows[begin] // BLOCK,
            np.append(begin, len(rows)), most, prior, (y[blank].sum() + prior) / (blank.sum() + 1),
        )

    def nearest(self, at: np.ndarray, weight: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The `k` examples of largest cosine (above 0) and all that are as near as the last of them, with their cosines, exactly.

        A block can hold no cosine above the sum of its terms' largest weights; blocks are opened in descending order of that bound, until
        the k-th best found is above all that remain. Cosines are compared at nine digits.
        """
        many = self.first[at + 1] - self.first[at]
        entry, by_term = _spans(self.first[at], many), np.repeat(weight, many)
        where = self.place[entry]
        bound = np.round(np.bincount(where, by_term * self.most[entry], -(-len(self.ids) // BLOCK)), 9)
        order = np.argsort(-bound, kind="stable")
        order = order[bound[order] > 0]
        slot = np.empty(len(bound), np.int64)
        best, sims, step, opened = np.zeros(0, np.int64), np.zeros(0), 4, 0
        while opened < len(order) and not (len(sims) >= k and sims[k - 1] > bound[order[opened]]):
            some = np.sort(order[opened : opened + step])
            opened, step = opened + step, 2 * step
            slot[:] = -1
            slot[some] = np.arange(len(some))
            # the postings of all terms in these blocks, term by term
            of = np.flatnonzero(slot[where] >= 0)
            length = self.begin[entry[of] + 1] - self.begin[entry[of]]
            posting, w = _spans(self.begin[entry[of]], length), np.repeat(by_term[of], length)
            who = self.examples[posting]
            sums = np.bincount(slot[who // BLOCK] * BLOCK + who % BLOCK, w * self.weights[posting], len(some) * BLOCK)
            hit = np.flatnonzero(sums > 0)
            best = np.concatenate([best, some[hit // BLOCK] * BLOCK + hit % BLOCK])
            sims = np.concatenate([sims, np.round(sums[hit], 9)])
            top = np.lexsort((best, -sims))
            best, sims = best[top], sims[top]
            if len(sims) > k:
                near = sims >= sims[k - 1]
                best, sims = best[near], sims[near]
        return best, sims

    def vote(self, at: np.ndarray, tf: np.ndarray, k: int, weight_of_prior: float) -> tuple[float, np.ndarray, np.ndarray]:
        """Score, and the evidence: ids of the nearest examples and their cosines. Nearer ones count more, by the square.

        Examples that are as near as the k-th share its and its equals' places, so ids take no part in a score. Evidence names `k`.
        """
        if not len(at):
            return float(self.blank), np.zeros(0, np.int64), np.zeros(0)
        best, sims = self.nearest(at, unit(at, tf, self.idf), k)
        votes = sims**2
        if len(sims) > k:
            last = sims == sims[k - 1]
            votes[last] *= (k - (~last).sum()) / last.sum()
        score = (votes @ self.labels[best] + weight_of_prior * self.prior) / (votes.sum() + weight_of_prior)
        return float(score), self.ids[best[:k]], sims[:k]


def unit(at: np.ndarray, tf: np.ndarray, idf: np.ndarray) -> np.ndarray:
    w = (1 + np.log(tf)) * idf[at]
    return w / np.sqrt(w @ w)


def score_toxicity(docs: DataFrame, labels: DataFrame, at_most: int = LABELLED, terms: int | None = None, k: int = 15, weight_of_prior: float = 0.5) -> DataFrame:
    """doc_id, score, and the evidence neighbours (array of doc_id, cosine) of every row of `docs`.

    Terms are all that tell label 1 in the labelled examples (`choose_terms`; at most `terms` if given), of which at most `at_most` are
    taken (those with the smallest hashed ids); a text's other words stand in no vector. How rare a term is, is counted over all of `docs`. The index of examples has that proven size and goes to every
    worker; each document asks it once.

    A text without any chosen term, null and empty ones included, has the smoothed share of label 1 among
    such examples as its score, and no evidence. Without labels of both kinds every score is the smoothed share.
    Repeated rows have equal scores; no rows, no result.
    """
    spark = docs.sparkSession
    known = labelled_sample(labels, "toxic", at_most)
    texts = whole_text(docs).join(F.broadcast(known), "doc_id").select("doc_id", "text", "label")  # `at_most` ids and labels
    chosen = choose_terms(texts, terms)
    counted = materialize(vectors(whole_text(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text"), chosen), "vectors")
    n = counted.count()
    holding = {r.at: r.n for r in counted.select(F.explode("at").alias("at")).groupBy("at").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row for each chosen term
    idf = np.array([np.log((1 + n) / (1 + holding.get(i, 0))) + 1 for i in range(len(chosen))])
    examples = counted.join(F.broadcast(known), "doc_id").distinct().toPandas()  # `at_most` examples
    examples = examples.sort_values("doc_id", kind="stable")
    index = spark.sparkContext.broadcast(
        Index.build(examples.doc_id.tolist(), examples.label.tolist(), examples["at"].tolist(), examples.tf.tolist(), idf)
    )

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known_votes: dict[tuple, tuple] = {}
        for batch in batches:
            scores, evidence = [], []
            for at, tf in zip(batch.column("at").to_pylist(), batch.column("tf").to_pylist()):
                key = (*at, *tf)
                if key not in known_votes:
                    if len(known_votes) > 100_000:
                        known_votes.clear()
                    s, ids, sims = index.value.vote(np.array(at, np.int64), np.array(tf, np.float64), k, weight_of_prior)
                    known_votes[key] = s, [{"doc_id": int(i), "cosine": float(c)} for i, c in zip(ids, sims)]
                s, near = known_votes[key]
                scores.append(s)
                evidence.append(near)
            near_type = pa.list_(pa.struct([("doc_id", pa.int64()), ("cosine", pa.float64())]))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64()), pa.array(evidence, near_type)], ["doc_id", "score", "neighbours"])

    return counted.mapInArrow(score, "doc_id long, score double, neighbours array<struct<doc_id: long, cosine: double>>")
