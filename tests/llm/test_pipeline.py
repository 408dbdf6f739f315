"""The pipeline's stages against what its operators promise."""

import corpus_pipeline
from ledgerlens.llm import quality_rules
from ledgerlens.llm.common import materialize

DIR = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    kept = {r["doc_id"] for r in quality_rules.judge(docs).where("kept").collect()}
    names, before = docs.columns, None
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = materialize(stage(spark, docs, DIR))
        ids = [r["doc_id"] for r in docs.collect()]
        assert len(ids) == len(set(ids))
        if k == 0:
            assert set(ids) == kept
        if before is not None:
            assert set(ids) <= before
        if k < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == names
        before = set(ids)
    assert docs.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    labels = spark.read.parquet(f"{DIR}/labels.parquet").where("quality = 1 AND toxic = 0")
    clean = {r["doc_id"] for r in labels.collect()} & kept
    assert len(clean & before) > 0.85 * len(clean)


def test_run_equals_stages(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, DIR))
    assert sorted(map(tuple, docs.collect())) == sorted(map(tuple, corpus_pipeline.run(spark, DIR).collect()))


def test_empty(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, DIR))
        assert docs.isEmpty()
