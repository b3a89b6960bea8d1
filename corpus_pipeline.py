"""Corpus pipeline: language ID, toxicity, near-duplicates, packing, over the `documents` table.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the
next stage's docs.  A stage works on all rows its predecessor kept; all but the last return the columns of
documents.  Learning in a stage uses the stage's own input and keeps to the fold rule of the operators.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from panelspark.llm import langid, minhash, packing, toxicity
from panelspark.llm.common import staged, table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents whose text may be in one of the learned languages."""
    model = langid.learn(docs)
    return langid.keep_identified(docs, model, langid.learn_floors(docs, model))


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents that are not predicted toxic."""
    return toxicity.keep_clean(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each class of near-duplicates."""
    return minhash.keep_one(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the kept documents in training sequences."""
    return packing.packing_ledger(docs)


STAGES = [
    ("language_id", language_id),
    ("toxicity", toxicity_filter),
    ("near_dedup", near_dedup),
    ("packing", packing_stage),
]

#: SQL cannot express the stages; tests/llm holds each against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir; each stage's rows are written before the next one reads them."""
    docs = table(spark, sf_dir, "documents")
    for at, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if at + 1 < len(STAGES):
            docs = staged(docs)
    return docs
