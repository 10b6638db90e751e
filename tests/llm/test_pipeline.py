from array import array

import corpus_pipeline
from tests_llm_helpers import brute_components

from sondeframe.llm.tokens import UnitEncoder, public_path


def test_stages_take_effect(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    counts, seen = [docs.count()], docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        before, seen = seen, stage(spark, seen, sf).cache()
        assert seen.columns == docs.columns and seen.join(before, "doc_id", "left_anti").count() == 0
        counts.append(seen.count())
    assert counts[0] > counts[1] >= counts[2] > 0
    stage_in = before
    rows = [(r.doc_id, r.text) for r in stage_in.collect()]
    assert {r.doc_id for r in seen.collect()} == set(brute_components(rows, 5, 80, 100).values())
    out = corpus_pipeline.run(spark, sf).collect()
    ids = dict(zip([r.doc_id for r in seen.collect()], UnitEncoder(public_path("byte_bpe_50k.json"), "byte").encode([r.text for r in seen.collect()]), strict=True))
    assert {r.doc_id for r in out} == set(ids) and sum(r.length for r in out) == sum(len(array("I", x)) + 1 for x in ids.values())


def test_odd_rows(spark, sf, odd_docs):
    docs = odd_docs.drop("rank")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf)
    assert {r.doc_id for r in docs.collect()} <= {1, 4, 5, None}


def test_stages_take_an_empty_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, sf).count() == 0
