import zlib

import pytest
from pyspark.sql import functions as F

from sessionweave.llm.sharding import document_shards, domain, permute, shard_rows, write_shards


@pytest.mark.parametrize("n", [1, 2, 3, 7, 10, 100, 1000, 4097])
def test_permutation_is_one_to_one(spark, n):
    a, b = domain(n)
    assert n <= a * b < n + a
    got = [r[0] for r in spark.range(n).select(permute(F.col("id"), n, 3)).collect()]
    assert sorted(got) == list(range(n))
    if n >= 100:
        assert got != sorted(got)
        assert got != [r[0] for r in spark.range(n).select(permute(F.col("id"), n, 4)).collect()]


def test_documents_get_gapless_slots_and_even_shards(spark, edge_docs):
    rows = document_shards(edge_docs, 5).collect()
    assert len(rows) == edge_docs.count()
    slots = {}
    for r in rows:
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    counts = [len(slots.get(i, [])) for i in range(5)]
    assert max(counts) - min(counts) <= 1
    texts = {r.doc_id: (r.text or "").encode() for r in edge_docs.collect()}
    assert all(r["size"] == len(texts[r.doc_id]) + 8 and r.text_crc32 == zlib.crc32(texts[r.doc_id]) for r in rows)
    assert all(r.law == "rows" and r.grown_shard is None for r in rows)


def test_order_of_rows_does_not_matter(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    one = {tuple(r) for r in document_shards(docs).collect()}
    two = {tuple(r) for r in document_shards(docs.orderBy(F.desc("text")).repartition(7)).collect()}
    assert one == two and len(one) == docs.count()


def test_empty_and_general_tables(spark, no_docs, tmp_path):
    assert document_shards(no_docs).count() == 0
    rows = spark.range(50).select((F.col("id") % 3).alias("k"), F.lit(None).cast("string").alias("slot"))
    placed = shard_rows(rows, 4).collect()
    assert len(placed) == 50 and len({(r.shard, r.slot) for r in placed}) == 50
    write_shards(rows, 4, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).groupBy("shard").count().count() == 4
    with pytest.raises(ValueError):
        shard_rows(rows, 0)
