"""From raw documents to packed training sequences: five stages, each written out before the next reads it.

A null text counts as empty in every stage and stays null in the rows that are kept; an empty table passes through
empty. Repeated rows are one document to the stages that drop copies, and as many as there are to the others. Columns
beyond those of `documents` are kept as they are, whatever their names, up to the last stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from wagerlens.llm.common import materialize
from wagerlens.llm.exact_dedup import drop_exact
from wagerlens.llm.mixing import mixed
from wagerlens.llm.packing import pack
from wagerlens.llm.quality import keep_good
from wagerlens.llm.queries import ACCEPTED, VOCABULARY
from wagerlens.llm.simhash import drop_near

# Clean documents are to stay whole, so they anchor the budget and no document is taken twice.
MIXTURE = {"clean": 0.95, "toxic": 0.03, "poor": 0.02}


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return keep_good(docs, _labels(spark, sf_dir), at_least=ACCEPTED)


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every distinct text: the one with the largest id."""
    return drop_exact(docs, keep="largest")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near copies (three words, 2 bits of the fingerprint): the one with the smallest id."""
    return drop_near(docs, width=3, max_distance=2)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents at the rates that bring the domains to their weights."""
    return mixed(docs, _labels(spark, sf_dir), MIXTURE, anchor="clean", slack=1.02, most=1.0)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in the training sequences."""
    return pack(docs, public_tokenizers.path(VOCABULARY), end_id=1, limit=4096)


STAGES = [
    ("quality", quality), ("exact_duplicates", exact_duplicates), ("near_duplicates", near_duplicates), ("mixing", mixing),
    ("packing", packing),
]

ORACLE_SQL = None  # classifiers and packing are beyond SQL; tests compare the stages with plain versions


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
