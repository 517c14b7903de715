"""A corpus pipeline: documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet
and reread as the next one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from placeweave.llm import jaccard, langid, packing, pii, toxicity
from placeweave.llm.common import table, written


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID: documents whose language it can't tell go."""
    return langid.keep_known(docs, langid.train(docs))


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Toxicity: documents that score 0.7 or more go."""
    return toxicity.keep_clean(docs, toxicity.train(docs, table(spark, sf_dir, "labels")), 0.7)


def deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join, five words and 0.8: the smallest doc_id of each group stays."""
    return jaccard.keep_one(docs, 5, 80)


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """PII: surrogates for personal data."""
    return pii.replace(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Best-fit packing into sequences of at most 2048 tokens."""
    return packing.pack_documents(docs, 2048, 0)


STAGES = [
    ("language_id", language),
    ("toxicity", clean),
    ("ngram_jaccard", deduplicated),
    ("pii", private),
    ("best_fit_packing", packed),
]

#: Learned models and tokenizers are no SQL; the stages are tested one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = written(docs, name)
    return docs
