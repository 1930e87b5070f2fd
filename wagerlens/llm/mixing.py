"""Mix documents to target weights of domains they belong to softly."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wagerlens.llm.common import materialize, whole_text
from wagerlens.llm.quality import LABELLED
from wagerlens.llm.textstats import NAMES, statistics
from wagerlens.llm.toxicity import STEM, choose_terms, distinct_words

DOMAINS = ("clean", "toxic", "poor")
TERMS = 512
_REFRESH = 8  # rates are written out after so many steps, so that none of them is computed over and over


def labelled_domains(labels: DataFrame, at_most: int = LABELLED) -> DataFrame:
    """(doc_id, label): the place in DOMAINS of at most `at_most` labelled ids, those with the smallest hashes.

    Poor is quality 0; toxic is toxic 1 among the rest; of contradicting labels the worse counts.
    """
    known = labels.where("doc_id is not null and quality is not null and toxic is not null").groupBy("doc_id")
    label = F.when(F.min("quality") == 0, 2).when(F.max("toxic") == 1, 1).otherwise(0).alias("label")
    return known.agg(label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(at_most)


@dataclass(frozen=True)
class DomainModel:
    """Softmax regression over text statistics and the weight of telling terms."""

    terms: dict[str, float]
    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray  # (features + 1) x domains

    def measured(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Features of whole texts, and their tokens (white-space separated words). A text is split once for all of them."""
        x, tokens = np.zeros((len(texts), len(NAMES) + 3)), np.zeros(len(texts))
        # which stems can matter is known from the terms
        stems = {t[:STEM] for t in self.terms if t.endswith("*")}
        for i, text in enumerate(texts):
            counted = Counter(text.split())
            words = distinct_words(counted)
            told = [self.terms[w] for w in words & self.terms.keys()]
            told += [self.terms[s + "*"] for s in {w[:STEM] for w in words if len(w) > STEM} & stems]
            x[i] = [*statistics(text, counted), math.fsum(told), len(told), max(told, default=0.0)]
            tokens[i] = counted.total()
        x[:, len(NAMES) :] = np.log1p(np.maximum(x[:, len(NAMES) :], 0))
        return x, tokens

    def posteriors(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """How likely whole texts belong to each of DOMAINS, and their tokens."""
        x, tokens = self.measured(texts)
        x = (x - self.mean) / self.spread
        return softmax(np.concatenate([x, np.ones((len(x), 1))], axis=1) @ self.weights), tokens


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def regress(x: np.ndarray, y: np.ndarray, domains: int, ridge: float = 1e-3, steps: int = 400) -> np.ndarray:
    """Weights of a softmax regression, by accelerated gradient steps; x standardized, with a last column of ones."""
    truth = np.eye(domains)[y]
    size = max(len(x), 1)
    rate = 1.0 / (0.5 * np.linalg.norm(x.T @ x / size, 2) + ridge) if len(x) else 0.0
    w = ahead = np.zeros((x.shape[1], domains))
    for step in range(steps):
        new = ahead - rate * (x.T @ (softmax(x @ ahead) - truth) / size + ridge * ahead)
        ahead, w = new + step / (step + 3) * (new - w), new
    return w


def fit_domains(docs: DataFrame, labels: DataFrame, at_most: int = LABELLED, terms: int = TERMS) -> DomainModel:
    """The classifier, fitted on the texts of at most `at_most` labelled documents; without any, domains are equally likely."""
    known = labelled_domains(labels, at_most)
    texts = whole_text(docs).join(F.broadcast(known), "doc_id").select("doc_id", "text", "label")  # `at_most` ids and labels
    telling = choose_terms(texts.where("label < 2"), terms)
    blank = DomainModel({t: 1.0 for t in telling}, np.zeros(1), np.ones(1), np.zeros((len(NAMES) + 4, len(DOMAINS))))

    def measure(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame({"doc_id": frame.doc_id, "label": frame.label, "x": list(blank.measured(frame.text.tolist())[0])})

    measured = texts.mapInPandas(measure, "doc_id long, label int, x array<double>").toPandas()
    measured = measured.sort_values(["doc_id", "label"], kind="stable")
    x = np.array(measured.x.tolist(), np.float64).reshape(len(measured), len(NAMES) + 3)
    if not len(x):
        return DomainModel(blank.terms, np.zeros(x.shape[1]), np.ones(x.shape[1]), blank.weights)
    mean, spread = x.mean(axis=0), x.std(axis=0) + 1e-9
    x = np.concatenate([(x - mean) / spread, np.ones((len(x), 1))], axis=1)
    return DomainModel(blank.terms, mean, spread, regress(x, measured.label.to_numpy(int), len(DOMAINS)))


def memberships(text: Column, model: DomainModel) -> Column:
    """array<double>: how likely the whole text belongs to each of DOMAINS, then its tokens (white-space separated words)."""

    @F.pandas_udf("array<double>")
    def member(texts: pd.Series) -> pd.Series:
        return pd.Series(list(np.column_stack(model.posteriors(texts.tolist()))))

    return member(F.coalesce(text, F.lit("")))


def stepped(rate: Column, soft: Column, pushes: list[list[float]], most: float | None) -> Column:
    """`rate` after the projected steps `pushes`: down by the document's share in each domain's push, never below 0 or above `most`."""
    if not pushes:
        return rate

    def step(r: Column, push: Column) -> Column:
        down = r - F.aggregate(F.zip_with(push, soft, lambda p, s: p * s), F.lit(0.0), lambda total, x: total + x)
        return F.greatest(down, F.lit(0.0)) if most is None else F.least(F.greatest(down, F.lit(0.0)), F.lit(float(most)))

    # a push of nothing goes with the last number of `soft`, the tokens
    return F.aggregate(F.array(*[F.array(*[F.lit(float(p)) for p in [*push, 0.0]]) for push in pushes]), rate, step)


def fit_rates(soft: DataFrame, wanted: list[float], most: float | None = None, steps: int = 40, near: float = 1e-4) -> list[list[float]]:
    """The steps that lead from rate 1 to rates whose expected domain tokens are `wanted`, as closely as non-negative rates allow.

    `soft` has soft (DOMAINS, then tokens). Minimizes the sum over domains of (expected - wanted)^2 / tokens of the domain,
    by projected gradients in the metric that counts documents by their tokens. There a step is the same for all
    documents of equal membership, step length 1 is safe (memberships add up to 1), and the driver needs a number for each
    domain, a grouped sum over all documents. Documents' rates stay with the documents.
    """
    domains = range(len(wanted))
    # rates depend on a document's row alone; the sums are all that leaves the executors
    now, pushes, fresh = soft.withColumn("rate", F.lit(1.0)), [], []
    tokens = F.get("soft", len(wanted))
    held = soft.agg(*[F.sum(tokens * F.get("soft", k)).alias(f"k{k}") for k in domains]).first()
    held = [held[k] or 0.0 for k in domains]
    for _ in range(steps):
        rate = stepped(F.col("rate"), F.col("soft"), fresh, most)
        sums = now.agg(*[F.sum(tokens * F.get("soft", k) * rate).alias(f"k{k}") for k in domains]).first()
        off = [(sums[k] or 0.0) - wanted[k] for k in domains]
        push = [off[k] / held[k] if held[k] > 0 else 0.0 for k in domains]
        if fresh and all(abs(a - b) < near for a, b in zip(push, fresh[-1])):
            break
        fresh.append(push)
        pushes.append(push)
        if max(map(abs, push)) < near:
            break
        if len(fresh) == _REFRESH:
            now = materialize(now.withColumn("rate", stepped(F.col("rate"), F.col("soft"), fresh, most)), "rates")
            fresh = []
    return pushes


def budget(held: list[float], weights: dict[str, float], total: float | None, anchor: str | None, slack: float) -> list[float]:
    """Tokens wanted of each domain. In all `total`; or as many as make `anchor` whole, times `slack`; or as many as there are."""
    share = [weights[d] / sum(weights.values()) for d in DOMAINS]
    if anchor is not None:
        total = slack * held[DOMAINS.index(anchor)] / share[DOMAINS.index(anchor)]
    return [s * (sum(held) if total is None else total) for s in share]


@dataclass(frozen=True)
class Mixture:
    """A fitted mixture: the classifier and the steps to the rates."""

    model: DomainModel
    pushes: list[list[float]]
    most: float | None

    def rate(self, soft: Column) -> Column:
        return stepped(F.lit(1.0), soft, self.pushes, self.most)

    def rate_of_text(self, text: Column) -> Column:
        """The same from a whole text, in one go. Not declared deterministic, so that it is computed once a row."""
        model, pushes, most = self.model, self.pushes, np.inf if self.most is None else self.most

        @F.pandas_udf("double")
        def rate(texts: pd.Series) -> pd.Series:
            soft, out = model.posteriors(texts.tolist())[0], np.ones(len(texts))
            for push in pushes:
                out = np.clip(out - soft @ np.array(push), 0.0, most)
            return pd.Series(out)

        return rate.asNondeterministic()(text)


def fit_mixture(docs: DataFrame, labels: DataFrame, weights: dict[str, float], total: float | None = None, anchor: str | None = None,
                slack: float = 1.0, most: float | None = None, at_most: int = LABELLED) -> tuple[Mixture, DataFrame]:
    """The mixture for `docs`, and doc_id and soft of every row."""
    model = fit_domains(docs, labels, at_most)
    soft = materialize(whole_text(docs).select("doc_id", memberships(F.col("text"), model).alias("soft")), "soft")
    tokens = F.get("soft", len(DOMAINS))
    held = soft.agg(*[F.sum(tokens * F.get("soft", k)).alias(f"k{k}") for k in range(len(DOMAINS))]).first()
    wanted = budget([held[k] or 0.0 for k in range(len(DOMAINS))], weights, total, anchor, slack)
    return Mixture(model, fit_rates(soft, wanted, most), most), soft


def copies(doc_id: Column, rate: Column) -> Column:
    """How often a document is taken: `rate`, rounded up for a share of all ids that is its fraction, by hashed id."""
    part = F.pmod(F.xxhash64(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit("mixing")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return (F.floor(rate) + (part < rate - F.floor(rate)).cast("long")).cast("long")


def mixing_rates(docs: DataFrame, labels: DataFrame, weights: dict[str, float], **settings) -> DataFrame:
    """doc_id, n_tokens, a posterior for each of DOMAINS, rate and copies of every row of `docs`.

    Null and empty texts have no tokens; their rates follow from their memberships like any other. Repeated rows have equal rates. A domain
    nobody belongs to cannot be raised and is left out of account. No rows, no result.
    """
    mixture, soft = fit_mixture(docs, labels, weights, **settings)
    rated = soft.withColumn("rate", mixture.rate(F.col("soft")))
    return rated.select(
        "doc_id", F.get("soft", len(DOMAINS)).cast("long").alias("n_tokens"),
        *[F.get("soft", k).alias(d) for k, d in enumerate(DOMAINS)], "rate", copies(F.col("doc_id"), F.col("rate")).alias("copies"),
    )


def mixed(docs: DataFrame, labels: DataFrame, weights: dict[str, float], **settings) -> DataFrame:
    """`docs` with every row as often as the mixture takes it; nothing is shuffled. Columns may have any names."""
    mixture, _ = fit_mixture(docs, labels, weights, **settings)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    text, doc_id = F.coalesce(F.col("row.text"), F.lit("")), F.col("row.doc_id")
    rated = docs.select(row.alias("row")).withColumn("rate", mixture.rate_of_text(text))
    taken = rated.withColumn("times", copies(doc_id, F.col("rate"))).where("times > 0")
    out = taken.withColumn("turn", F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))))
    return out.select([F.col(f"row.`{c}`").alias(c) for c in docs.columns])
