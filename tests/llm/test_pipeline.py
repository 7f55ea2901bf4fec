"""The pipeline's stages, each on what its predecessor kept."""

import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")

from cadenza.llm import mixing, ngram_join, pieces, quality  # noqa: E402


def test_stages(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    first = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf).cache()
        assert out.columns == first.columns
        ids = {r[0] for r in docs.select("doc_id").collect()}
        assert {r[0] for r in out.select("doc_id").collect()} <= ids
        if name == "quality":
            rejected = {r["doc_id"] for r in quality.classify(docs, spark.read.parquet(f"{sf}/labels.parquet")).where("predicted = 0").collect()}
            assert {r["doc_id"] for r in out.collect()} == ids - rejected
        if name == "ngram_join":
            assert out.count() == ngram_join.join(docs).select("component_id").distinct().count()
        if name == "secrets":
            assert out.count() == docs.count()
        if name == "mixing":
            want = sum(r["copies"] for r in mixing.mix(docs).where("size > 0").collect())
            assert out.count() == want
        docs = out
    last = corpus_pipeline.STAGES[-1][1](spark, docs, sf).collect()
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    table = pieces.table(pieces.default_model())
    assert len(last) == docs.count()
    assert all(r["ids"] == table.encode(texts[r["doc_id"]]) for r in last)
