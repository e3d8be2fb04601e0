"""The registered queries of this subpackage and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starfold.llm import (
    alignment, ann, bpe, decontaminate, lexical, packing, pii, quality, secret_scan, sharding, simhash,
    token_counts, toxicity,
)
from starfold.llm.common import table
from starfold.sources import shared_folder

BPE = {
    "model": public_tokenizers.path("byte_bpe_50k.json"),
    "ranks": public_tokenizers.path("byte_bpe_50k.tiktoken"),
    "pattern": public_tokenizers.PATTERN,
}
WORDS = {"model": public_tokenizers.path("word_bpe_49k.json"), "end_id": 2}
ALIGNED = {
    "ranks": BPE["ranks"], "pattern": BPE["pattern"],
    "pieces": public_tokenizers.path("piece_bpe_32k.model"),
}


def op1_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.score_documents(
        table(spark, folder, "documents"), table(spark, folder, "labels"), folds=5, fold=0, threshold=0.3
    )


def op2_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.score_documents(
        table(spark, folder, "documents"), table(spark, folder, "labels"), folds=3, fold=1, threshold=0.7
    )


def op3_ann(spark: SparkSession, folder: str) -> DataFrame:
    return ann.search(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op4_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.encode(table(spark, folder, "documents").select("doc_id", "text"), **BPE)


def op5_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secret_scan.scan(table(spark, folder, "documents"))


def op6_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Two tokenizer versions side by side, one of them the public BPE."""
    beside = ("byte_bpe_50k", token_counts.bpe(**BPE))
    documents, path = table(spark, folder, "documents"), shared_folder(spark, "token_counts")
    return token_counts.build(documents, path, beside=beside).totals()


def token_counts_by_pattern(spark: SparkSession, folder: str) -> DataFrame:
    """The versions that SQL can count."""
    documents = table(spark, folder, "documents")
    return token_counts.build(documents, shared_folder(spark, "token_counts")).totals()


def op7_sharding(spark: SparkSession, folder: str) -> DataFrame:
    placed = sharding.shard_documents(table(spark, folder, "documents"), shards=16)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op8_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"), 4, 4)
    return found.selectExpr("doc_id", "lpad(lower(hex(fp)), 16, '0') AS fingerprint", "component_id")


def op9_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.scan(table(spark, folder, "documents"))


def op10_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contamination(
        table(spark, folder, "documents"), table(spark, folder, "benchmark"), window=10
    )


def op11_lexical(spark: SparkSession, folder: str) -> DataFrame:
    return lexical.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"), k=20)


def op12_packing(spark: SparkSession, folder: str) -> DataFrame:
    tokens = packing.tokenized(table(spark, folder, "documents"), **WORDS, window=4096)
    return packing.digests(packing.pack(tokens, window=4096), tokens).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )


def op13_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return alignment.align(table(spark, folder, "documents"), **ALIGNED)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_quality": op1_quality,
        "op2_toxicity": op2_toxicity,
        "op3_ann": op3_ann,
        "op4_bpe": op4_bpe,
        "op5_secret_scan": op5_secret_scan,
        "op6_token_counts": op6_token_counts,
        "op7_sharding": op7_sharding,
        "op8_simhash": op8_simhash,
        "op9_pii": op9_pii,
        "op10_decontaminate": op10_decontaminate,
        "op11_lexical": op11_lexical,
        "op12_packing": op12_packing,
        "op13_alignment": op13_alignment,
        "token_counts_by_pattern": token_counts_by_pattern,
    }


_TOKEN_COUNTS = r"""
WITH counted AS (
    SELECT doc_id, source, lang,
           LEN(REGEXP_EXTRACT_ALL(COALESCE(text, ''),
               '[0-9]+|[A-Za-z\x{80}-\x{10FFFF}]+|[\x21-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E]')) AS n,
           MIN(doc_id) OVER (PARTITION BY COALESCE(text, '')) AS first_id
    FROM documents
)
SELECT source, lang, 'pieces-2' AS tokenizer, COUNT(*) AS documents, CAST(SUM(n) AS BIGINT) AS tokens
FROM counted WHERE NOT COALESCE(doc_id > first_id, FALSE) GROUP BY source, lang
"""


_WORDS = r"""REGEXP_EXTRACT_ALL(
    TRANSLATE(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

_CONTAMINATION = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents)
, i AS (
    SELECT CAST(item_id AS VARCHAR) AS item, w, LEAST(10, LEN(w)) AS k
    FROM (SELECT item_id, {_WORDS} AS w FROM benchmark) WHERE LEN(w) > 0
)
, item_window AS (
    SELECT DISTINCT item, k, ARRAY_TO_STRING(w[s : s + k - 1], ' ') AS gram
    FROM (SELECT *, UNNEST(RANGE(1, LEN(w) - k + 2)) AS s FROM i)
)
, doc_window AS (
    SELECT doc_id, s, k, ARRAY_TO_STRING(w[s : s + k - 1], ' ') AS gram
    FROM (SELECT doc_id, w, k, UNNEST(RANGE(1, LEN(w) - k + 2)) AS s
          FROM d, (SELECT DISTINCT k FROM item_window) WHERE LEN(w) >= k)
)
, hit AS (SELECT doc_id, s, k, item FROM doc_window JOIN item_window USING (k, gram))
, place AS (
    SELECT doc_id, COUNT(DISTINCT p) AS n_hit
    FROM (SELECT doc_id, UNNEST(RANGE(s, s + k)) AS p FROM hit) GROUP BY doc_id
)
, found AS (
    SELECT doc_id, COUNT(*) AS n_items, STRING_AGG(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id
)
SELECT doc_id, CAST(LEN(w) AS BIGINT) AS n_words, COALESCE(n_hit, 0) AS n_hit,
       COALESCE(n_items, 0) AS n_items, SHA256(COALESCE(items, '')) AS items_sha256,
       n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN place USING (doc_id) LEFT JOIN found USING (doc_id)
"""


_LEXICAL = f"""
WITH d AS (SELECT doc_id, UNNEST({_WORDS}) AS term FROM documents)
, tf AS (SELECT doc_id, term, COUNT(*) AS tf FROM d GROUP BY doc_id, term)
, own AS (SELECT doc_id, COUNT(*) AS n FROM d GROUP BY doc_id)
, whole AS (SELECT COUNT(*) AS documents, CAST(SUM(n) AS BIGINT) AS length FROM own)
, m AS (SELECT doc_id, 100 - 25 + (25 * n * documents) // length AS m FROM own, whole)
, w AS (
    SELECT term, CAST(FLOOR(1000 * LN(
        CAST(2 * (SELECT documents FROM whole) + 2 AS DOUBLE) / (2 * COUNT(*) + 1))) AS BIGINT) AS w
    FROM tf GROUP BY term
)
, q AS (SELECT item_id, UNNEST({_WORDS}) AS term FROM benchmark)
, found AS (
    SELECT item_id, doc_id,
           CAST(SUM(w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
    FROM q JOIN w USING (term) JOIN tf USING (term) JOIN m USING (doc_id) GROUP BY item_id, doc_id
)
SELECT item_id, doc_id, score,
       CAST(ROW_NUMBER() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank
FROM found WHERE score > 0 QUALIFY rank <= 20
"""


def oracle_sql() -> dict[str, str]:
    return {
        "token_counts_by_pattern": _TOKEN_COUNTS, "op10_decontaminate": _CONTAMINATION, "op11_lexical": _LEXICAL,
    }
