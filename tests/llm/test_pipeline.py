"""The corpus pipeline, stage by stage, on a small planted table."""

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from placeweave.llm import pii

WORDS = "the of and stone river light house green water cloud paper silver morning walk sing".split()
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def test_stages_take_effect(spark, tmp_path):
    rng = np.random.default_rng(8)
    texts = [" ".join(rng.choice(WORDS, 40)) + (" idiot moron" if i % 4 == 0 else "") for i in range(200)]
    texts += [texts[1], texts[1] + " sing", "1234 !!", None, "the river " + texts[2][:60] + " mail anna.bell@example.com now"]
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(200)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs, kept = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == columns
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        kept[name] = {r.doc_id for r in docs.select("doc_id").collect()}
    clean = {i for i in range(200) if i % 4}
    assert kept["language_id"] == set(range(202)) | {204}
    assert kept["toxicity"] == clean | {200, 201, 204}
    assert kept["ngram_jaccard"] == clean | {204} == kept["pii"] == kept["best_fit_packing"]
    private = spark.read.parquet(f"{tmp_path}/pii")
    assert private.where(F.col("text").contains("anna.bell")).count() == 0
    assert private.where(F.col("text").rlike(pii.PATTERNS[0][1])).count() == 1
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "toxicity", "ngram_jaccard", "pii", "best_fit_packing"]
    assert corpus_pipeline.ORACLE_SQL is None
