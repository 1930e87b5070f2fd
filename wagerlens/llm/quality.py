"""Text quality: gradient-boosted histogram trees over document statistics, kept as flat arrays."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wagerlens.llm.common import whole_text
from wagerlens.llm.textstats import NAMES, matrix

LABELLED = 20_000
"""Most labelled rows a model is fitted on: those with the smallest hashed ids."""


@dataclass(frozen=True)
class Trees:
    """A forest of complete binary trees of one depth; node i has children 2i+1 and 2i+2, leaves follow the nodes."""

    feature: np.ndarray  # trees x nodes
    threshold: np.ndarray  # trees x nodes; larger values go right
    leaf: np.ndarray  # trees x leaves
    base: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1: every row walks down all trees at once."""
        trees, nodes = self.feature.shape
        each = np.arange(trees)
        at = np.zeros((len(x), trees), np.int64)
        for _ in range(int(np.log2(nodes + 1))):
            value = np.take_along_axis(x, self.feature[each, at], axis=1)
            at = 2 * at + 1 + (value > self.threshold[each, at])
        return _logistic(self.base + self.leaf[each, at - nodes].sum(axis=1))


def _logistic(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def boost(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, bins: int = 32, rate: float = 0.15, ridge: float = 2.0) -> Trees:
    """Fit `trees` trees of `depth` to the logistic loss; splits are sought among `bins` quantiles of each feature."""
    x, y = np.asarray(x, np.float64), np.asarray(y, np.float64)
    nodes, leaves, width = 2**depth - 1, 2**depth, x.shape[1]
    feature, threshold = np.zeros((trees, nodes), np.int64), np.full((trees, nodes), np.inf)
    leaf = np.zeros((trees, leaves))
    if not len(y) or y.min() == y.max():
        return Trees(feature, threshold, leaf, float(np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))))
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(width)]
    binned = np.stack([np.searchsorted(cuts[j], x[:, j], "left") for j in range(width)], axis=1)  # bin > b  <=>  x > cuts[b]
    base = float(np.log(y.mean() / (1 - y.mean())))
    raw = np.full(len(y), base)
    for t in range(trees):
        p = _logistic(raw)
        gradient, weight = y - p, p * (1 - p)
        at = np.zeros(len(y), np.int64)
        for level in range(depth):
            first, many = 2**level - 1, 2**level
            gain = np.full((width, many, bins), -np.inf)
            for j in range(width):
                slot = (at - first) * bins + binned[:, j]
                g = np.bincount(slot, gradient, many * bins).reshape(many, bins).cumsum(axis=1)
                h = np.bincount(slot, weight, many * bins).reshape(many, bins).cumsum(axis=1)
                whole = g[:, -1:] ** 2 / (h[:, -1:] + ridge)
                made = g**2 / (h + ridge) + (g[:, -1:] - g) ** 2 / (h[:, -1:] - h + ridge) - whole
                gain[j, :, : len(cuts[j])] = made[:, : len(cuts[j])]
            best = gain.transpose(1, 0, 2).reshape(many, -1).argmax(axis=1)
            for node in range(many):
                j, b = divmod(int(best[node]), bins)
                if gain[j, node, b] > 1e-6:
                    feature[t, first + node], threshold[t, first + node] = j, cuts[j][b]
            at = 2 * at + 1 + (x[np.arange(len(y)), feature[t, at]] > threshold[t, at])
        g, h = np.bincount(at - nodes, gradient, leaves), np.bincount(at - nodes, weight, leaves)
        leaf[t] = rate * g / (h + ridge)
        raw += leaf[t, at - nodes]
    return Trees(feature, threshold, leaf, base)


def labelled_sample(labels: DataFrame, label: str, at_most: int) -> DataFrame:
    """(doc_id, label) of the `at_most` labelled ids with the smallest hashes; of contradicting labels the larger counts."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull()).groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    return known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(at_most)


def fit_quality(docs: DataFrame, labels: DataFrame, label: str = "quality", at_most: int = LABELLED) -> Trees:
    """Trees for `label`, fitted on the texts of at most `at_most` labelled documents; every input row of those takes part."""
    known = labelled_sample(labels, label, at_most)
    texts = whole_text(docs).join(F.broadcast(known), "doc_id").select("doc_id", "text", "label")  # `at_most` ids and labels
    measured = texts.mapInPandas(_measure, "doc_id long, label int, x array<double>").toPandas()
    measured = measured.sort_values(["doc_id", "label"], kind="stable")
    x = np.array(measured.x.tolist(), np.float64).reshape(len(measured), len(NAMES))
    return boost(x, measured.label.to_numpy(np.float64))


def _measure(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        yield pd.DataFrame({"doc_id": frame.doc_id, "label": frame.label, "x": list(matrix(frame.text.tolist()))})


def quality_score(text: Column, model: Trees) -> Column:
    """The score of a whole text, 0 to 1; null counts as empty."""

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(model.score(matrix(texts.tolist())))

    return score(F.coalesce(text, F.lit("")))


def score_quality(docs: DataFrame, labels: DataFrame, at_most: int = LABELLED) -> DataFrame:
    """doc_id and score of every row of `docs`, by trees fitted on `labels` (doc_id, quality).

    Null and empty texts are scored like any other. Without labels, or with labels of one kind, all scores
    are that kind's smoothed share. Repeated rows have the same score; no rows, no result. Only doc_id and
    text of `docs` are looked at, and doc_id only to find the label.
    """
    model = fit_quality(docs, labels, at_most=at_most)
    return whole_text(docs).select("doc_id", quality_score(F.col("text"), model).alias("score"))


def keep_good(docs: DataFrame, labels: DataFrame, at_least: float = 0.3, at_most: int = LABELLED) -> DataFrame:
    """The rows of `docs` that score `at_least`, unchanged; nothing is shuffled."""
    model = fit_quality(docs, labels, at_most=at_most)
    return docs.where(quality_score(F.col("text"), model) >= at_least)
