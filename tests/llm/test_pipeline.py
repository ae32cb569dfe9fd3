"""The pipeline's stages on the smallest table."""

from __future__ import annotations

import corpus_pipeline
from faretide.llm.ngram_jaccard import ngram_components
from faretide.llm.quality_rules import quality_rules
from faretide.session import stage

FOLDER = "/root/testdata/sf0.001"


def test_stages(spark):
    first = docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    kept = {}
    for name, step in corpus_pipeline.STAGES:
        docs = stage(step(spark, docs, FOLDER))
        kept[name] = docs
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == first.columns
    rules, classifier, near, mixture, tokens = kept.values()
    good = {r["doc_id"] for r in quality_rules(first).where("kept").collect()}
    assert {r["doc_id"] for r in rules.collect()} == good
    ids = {r["doc_id"] for r in near.collect()}
    groups = ngram_components(classifier).collect()
    assert ids == {r["doc_id"] for r in groups if r["doc_id"] == r["component_id"]}
    assert {r["doc_id"] for r in mixture.collect()} <= ids
    assert tokens.count() == mixture.count()
    assert tokens.where("size(ids) <> n_tokens").isEmpty()
