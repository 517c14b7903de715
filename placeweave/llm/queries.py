"""The queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, huffman, jaccard, langid, licenses, neighbours, packing, pii, toxicity, winnow
from .common import table


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), 2048, 0).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op2_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.redact_documents(table(spark, sf_dir, "documents"))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.document_digests(table(spark, sf_dir, "documents"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.predict_held_out(table(spark, sf_dir, "documents"))


def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"), 4, 85)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_held_out(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", F.size("blocks").alias("n_blocks"))


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return huffman.token_file_digests(table(spark, sf_dir, "documents"), 2)


def op9_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnow.edit_likeness(table(spark, sf_dir, "documents"))


def op10_hilbert_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), 20, 20)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_best_fit_packing, op2_pii_surrogates, op3_bpe, op4_language_id, op5_ngram_jaccard, op6_toxicity, op7_license_scan, op8_token_files, op9_winnowing, op10_hilbert_neighbours)}
