"""The operators of this package as registered queries, with production parameters, and SQL for those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wagerlens.llm.chunked_bpe import bpe_digest
from wagerlens.llm.common import id_crc
from wagerlens.llm.exact_dedup import exact_dedup
from wagerlens.llm.language_model import score_texts
from wagerlens.llm.lexical_search import search
from wagerlens.llm.mixing import mixing_rates
from wagerlens.llm.order_minhash import edited_fingerprints
from wagerlens.llm.packing import pack
from wagerlens.llm.quality import score_quality
from wagerlens.llm.simhash import near_groups
from wagerlens.llm.token_files import token_digest
from wagerlens.llm.toxicity import score_toxicity
from wagerlens.llm.url_rules import judge_urls, rule_table
from wagerlens.llm.whitening import whiten

VOCABULARY = "word_bpe_49k.json"
BYTE_VOCABULARY = "byte_bpe_50k.json"
RULES = (
    ("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"),
)
ACCEPTED = 0.3
MIXTURE = {"clean": 0.90, "toxic": 0.06, "poor": 0.04}


def _read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def op1_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup(_read(spark, folder, "documents"), keep="largest")


def op2_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return judge_urls(_read(spark, folder, "pages"), rule_table(spark, RULES))


def _judged(scored: DataFrame, held_out) -> DataFrame:
    predicted = (F.col("score") >= ACCEPTED).cast("int").alias("predicted")
    return scored.select("doc_id", held_out.alias("held_out"), "score", predicted)


def op3_quality(spark: SparkSession, folder: str) -> DataFrame:
    held_out = id_crc() % 5 == 0
    labels = _read(spark, folder, "labels").where(~held_out)
    return _judged(score_quality(_read(spark, folder, "documents"), labels), held_out)


def op4_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    held_out = id_crc() % 4 == 2
    labels = _read(spark, folder, "labels").where(~held_out)
    return _judged(score_toxicity(_read(spark, folder, "documents"), labels), held_out)


def op5_token_files(spark: SparkSession, folder: str) -> DataFrame:
    return token_digest(_read(spark, folder, "documents"), public_tokenizers.path(VOCABULARY), end_id=2)


def op6_language_model(spark: SparkSession, folder: str) -> DataFrame:
    return score_texts(_read(spark, folder, "documents"))


def op7_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack(_read(spark, folder, "documents"), public_tokenizers.path(VOCABULARY), end_id=1, limit=4096)


def op8_simhash(spark: SparkSession, folder: str) -> DataFrame:
    groups = near_groups(_read(spark, folder, "documents"), width=3, max_distance=2)
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op9_order_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return edited_fingerprints(_read(spark, folder, "documents"))


def op10_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing_rates(_read(spark, folder, "documents"), _read(spark, folder, "labels"), MIXTURE)


def op11_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    return search(_read(spark, folder, "documents"), _read(spark, folder, "benchmark"), k=50)


def op12_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whiten(_read(spark, folder, "embeddings"), components=32)


def op13_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe_digest(_read(spark, folder, "documents"), public_tokenizers.path(BYTE_VOCABULARY))


QUERIES = {
    f.__name__: f
    for f in (
        op1_exact_dedup, op2_url_filter, op3_quality, op4_toxicity, op5_token_files, op6_language_model, op7_packing,
        op8_simhash, op9_order_minhash, op10_mixing, op11_lexical_search, op12_whitening, op13_bpe,
    )
}

ORACLES = {
    "op1_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
    "op2_url_filter": """
        WITH cut AS (
            SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
        ), parts AS (
            SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
            FROM cut
        )
        SELECT page_id, host, path,
               CASE WHEN org AND (host = 'example.org' OR host LIKE '%.example.org') AND path LIKE '/es/%' THEN 'example.org/es/'
                    WHEN org AND (host = 'example.org' OR host LIKE '%.example.org') AND path LIKE '/en/1%' THEN 'example.org/en/1'
                    WHEN org AND path LIKE '/%' THEN 'org/'
                    WHEN com AND path LIKE '/fr/%' THEN 'com/fr/'
                    WHEN com AND path LIKE '/de/%' THEN 'com/de/' END AS rule,
               CASE WHEN org AND (host = 'example.org' OR host LIKE '%.example.org') AND (path LIKE '/es/%' OR path LIKE '/en/1%') THEN 'block'
                    WHEN com AND path LIKE '/de/%' THEN 'block' ELSE 'allow' END AS verdict
        FROM (SELECT *, host = 'org' OR host LIKE '%.org' AS org, host = 'com' OR host LIKE '%.com' AS com FROM parts)
    """,
    "op11_lexical_search": r"""
        WITH words AS (
            SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                     '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
            FROM documents
        ), counted AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY ALL
        ), lengths AS (SELECT doc_id, count(*) AS n FROM words GROUP BY doc_id
        ), totals AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS total FROM lengths
        ), asked AS (
            SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                              '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
            FROM benchmark
        ), weights AS (
            SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(docs) + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
            FROM counted, totals WHERE term IN (SELECT term FROM asked) GROUP BY term
        ), scored AS (
            SELECT item_id, doc_id,
                   CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * docs) // total)))) AS BIGINT) AS score
            FROM asked JOIN weights USING (term) JOIN counted USING (term) JOIN lengths USING (doc_id), totals GROUP BY item_id, doc_id
        )
        SELECT item_id, CAST(row_number() OVER best AS INTEGER) AS rank, doc_id, score FROM scored WHERE score > 0
        WINDOW best AS (PARTITION BY item_id ORDER BY score DESC, doc_id) QUALIFY row_number() OVER best <= 50
    """,
}
