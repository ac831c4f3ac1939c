"""The corpus pipeline: quality rules, language identification, near
duplicates, secrets, packing. Each stage takes ``(spark, docs, sf_dir)``; its
result is written as Parquet and read again as the next stage's ``docs``.

Stages 1 to 4 return the columns of ``documents``: rejected documents are
gone, removed lines and live secrets are gone from the texts (``n_chars``
follows), and of each class of near duplicates one document is left. The last
one returns the packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lexicount.llm import bagminhash, langid, packing, quality, secret_scan
from lexicount.llm._spark import written
from lexicount.sources import table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.clean(docs)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.accepted(docs, langid.learned(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bagminhash.deduplicated(docs)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.redacted(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.packed_documents(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("secret_scans", secret_scans),
    ("best_fit_packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs


#: SQL can't express the trained and hashed stages; tests/llm compares them
#: with brute-force versions.
ORACLE_SQL = None
