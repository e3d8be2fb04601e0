"""A training corpus from raw documents: five stages, each on what the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starfold.llm import bpe, decontaminate, secret_scan, simhash, toxicity
from starfold.llm.common import table, written
from starfold.llm.queries import BPE


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score less than 0.7."""
    return toxicity.reject(docs, table(spark, sf_dir, "labels"), threshold=0.7)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest doc_id, of each group that links of 4 bits connect."""
    return simhash.keep_one(docs, words_per_shingle=4, max_distance=4)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages of 10 words that a benchmark item has; documents that are mostly such
    passages go."""
    return decontaminate.remove_overlaps(docs, table(spark, sf_dir, "benchmark"), window=10)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with secrets replaced."""
    return secret_scan.redacted(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, with their number and the digests of ids and decoded text."""
    return bpe.encode(docs, **BPE, keep_ids=True)


STAGES = [
    ("toxicity", reject_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", remove_benchmark),
    ("secrets", redact_secrets),
    ("bpe", tokenize),
]

#: Learned scores, fingerprints and token ids are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in turn; each result is written and read again as the next one's documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


def queries() -> dict:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
