import hashlib

import corpus_pipeline
from sessionweave.llm.sentencepiece_codec import processor, read_model
from sessionweave.llm.toxicity import scored
from tests.llm.test_ngram_join import brute


def test_stages_one_by_one(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, by_name = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = corpus_pipeline.materialised(stage(spark, before, sf))
        by_name[name] = before, docs
        if name != "sentencepiece":
            assert docs.columns == columns
    before, after = by_name["toxicity"]
    bad = {r.doc_id for r in scored(before, spark.read.parquet(f"{sf}/labels.parquet")).where("predicted = 1").collect()}
    assert {r.doc_id for r in after.collect()} == {r.doc_id for r in before.collect()} - bad
    before, after = by_name["ngram_jaccard"]
    groups = brute({r.doc_id: r.text for r in before.collect()})
    assert {r.doc_id for r in after.collect()} == {i for i, (_, c) in groups.items() if i == c}
    before, after = by_name["sentencepiece"]
    sp = processor(read_model())
    ids = {r.doc_id: sp.encode(r.text or "", add_eos=True) for r in before.collect()}
    got = {r.doc_id: r for r in after.collect()}
    assert ids.keys() == got.keys()
    assert all(got[i].ids_sha256 == hashlib.sha256(" ".join(map(str, x)).encode()).hexdigest() for i, x in ids.items())


def test_stages_take_empty_tables(spark, sf, no_docs):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, no_docs, sf).count() == 0


def test_stages_take_odd_rows(spark, sf, edge_docs):
    docs = edge_docs
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.materialised(stage(spark, docs, sf))
        if name != "sentencepiece":
            assert docs.columns == edge_docs.columns
    assert docs.count() > 5
