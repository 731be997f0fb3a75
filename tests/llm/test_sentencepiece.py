import hashlib
import random

import pytest

from sessionweave.llm.sentencepiece_codec import chunk_table, chunks, decoded, encoded, head_of, processor, read_model


@pytest.fixture(scope="module")
def model():
    return read_model()


def test_same_ids_as_the_library(spark, model, edge_docs, sf):
    random.seed(5)
    parts = [" ", " ", "a", "th", "▁", "\n", "é", "😀", "\x00", "</s>", "e", "r", "​", "　", "the", "\t"]
    rows = [(10_000 + i, "".join(random.choices(parts, k=random.randint(0, 30)))) for i in range(400)]
    docs = edge_docs.select("doc_id", "text").union(spark.createDataFrame(rows, "doc_id long, text string"))
    docs = docs.union(spark.read.parquet(f"{sf}/documents.parquet").selectExpr("doc_id + 100000", "text"))
    sp = processor(model)
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    got = encoded(docs, model).collect()
    assert len(got) == docs.count()
    for r in got:
        ids = sp.encode(texts[r.doc_id], add_eos=True)
        assert r.ids == ids and r.n_tokens == len(ids) and r.decoded == sp.decode(ids)
    for r in encoded(docs, model, digests=True).collect():
        ids = sp.encode(texts[r.doc_id], add_eos=True)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(sp.decode(ids).encode()).hexdigest()


def test_chunk_table_and_decoding(spark, model):
    docs = spark.createDataFrame([(1, "a b  a"), (2, "a b"), (3, None)], "doc_id long, text string")
    table = chunk_table(docs, model)
    assert {r.chunk: r.n for r in table.collect()} == {" a": 2, " b": 2, "  a": 1}
    assert len(head_of(table, 10)) == 3 and chunks("") == [] and chunks(" ") == ["  "]
    texts = {r.doc_id: r.decoded for r in decoded(encoded(docs, model).drop("decoded"), model).collect()}
    assert texts == {1: "a b  a", 2: "a b", 3: ""}


def test_empty_table(no_docs, model):
    assert encoded(no_docs, model).count() == 0
