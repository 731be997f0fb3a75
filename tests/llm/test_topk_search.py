import math
import random

import pytest
from pyspark.sql import functions as F

from sessionweave.llm import topk_search as S
from sessionweave.llm.common import table

SCHEMA = "vec_id long, embedding array<double>"


def brute(rows, k=20, every=20):
    kept = []
    for vec_id, v in rows:
        if v is not None and all(x is not None and math.isfinite(x) for x in v):
            kept.append((vec_id, [math.floor(64 * x) for x in v]))
    out = []
    for i, (q, u) in enumerate(kept):
        if q is None or q % every:
            continue
        scores = [(-sum(a * b for a, b in zip(u, v)), c is None, c or 0, j, c) for j, (c, v) in enumerate(kept) if j != i]
        out += [(q, rank, c, -s) for rank, (s, _, _, _, c) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def search(df, k=20):
    return S.nearest(df, F.col("vec_id") % 20 == 0, k)


def test_query_equals_brute_force(spark, sf):
    rows = table(spark, sf, "embeddings")
    result = search(rows)
    assert result.columns == ["query_id", "rank", "vec_id", "score"]
    assert found(result) == brute([(r.vec_id, r.embedding) for r in rows.collect()])


@pytest.mark.parametrize("spread", [0.02, 1.0, 1e5])
def test_many_ties_small_tiles_and_large_numbers(spark, monkeypatch, spread):
    monkeypatch.setattr(S, "CANDIDATES", 40)
    monkeypatch.setattr(S, "QUERIES", 7)
    rng = random.Random(3)
    rows = [(i, [rng.gauss(0, spread) for _ in range(5)]) for i in range(260)]
    rows += [(1000 + i, rows[20][1]) for i in range(140)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(6)
    assert found(search(df)) == brute(rows)


def test_odd_rows(spark):
    rows = [
        (0, [0.5, -0.25]),
        (0, [0.5, -0.25]),
        (20, None),
        (40, [float("nan"), 1.0]),
        (60, [None, 1.0]),
        (80, []),
        (100, [0.5]),
        (1, [float("inf"), 0.0]),
        (2, [-0.001, 0.001]),
        (3, [0.5, -0.25, 8.0]),
        (None, [1.0, 1.0]),
        (120, [-1.0, 0.0]),
    ]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in ("q", "x", "row", "class", "score", "rank", "block", "id", "least")})
    assert found(search(df)) == brute(rows)
    assert found(search(df, 3)) == brute(rows, 3)
    assert search(df.where("false")).count() == 0
    assert search(spark.createDataFrame([(0, [1.0])], SCHEMA)).count() == 0
    large = [(0, [1e300, 1.0]), (1, [1e300, 0.0]), (2, [-1e300, 0.0])]
    assert found(search(spark.createDataFrame(large, SCHEMA))) == [(0, 1, 1, (1 << 63) - 1), (0, 2, 2, -(1 << 63))]


def test_products_beyond_double_cancel_exactly(spark):
    rng = random.Random(9)
    rows = [(i, [rng.choice((1, -1)) * 2.0**40, rng.choice((1, -1)) * 2.0**40, float(rng.randint(-9, 9)), 1.0]) for i in range(60)]
    rows = [(i, [a, -a if i % 2 else a, c, d]) for i, (a, _, c, d) in rows]
    exact = [r for r in brute(rows) if abs(r[3]) < 1 << 63]
    assert [r for r in found(search(spark.createDataFrame(rows, SCHEMA))) if abs(r[3]) < 1 << 62] == [r for r in exact if abs(r[3]) < 1 << 62]


def test_few_pairs_are_scored_in_full(spark):
    rows = table(spark, "/root/testdata/sf0.01", "embeddings")
    vectors = rows.select(F.col("vec_id").alias("class"), S.whole_numbers(F.col("embedding")).alias("vector"), F.col("vec_id").alias("least"))
    queries = vectors.where("class % 20 = 0")
    (candidates, candidate_parts), (asked, parts) = S.packed(vectors, 100), S.packed(queries, 10)
    best = S.best_classes(vectors, queries, 21)
    cutoffs = best.groupBy("q").agg(F.min("score").alias("cutoff"))
    entries = S.sufficient_entries(S._tiles(S.with_cutoffs(asked, cutoffs), parts, candidates, candidate_parts))
    n = entries.agg(F.sum(F.size("entries"))).first()[0]
    assert best.count() <= n < 0.5 * vectors.count() * queries.count()
    kept = S.resolved(entries, asked, candidates, 4)
    assert best.join(kept, ["q", "x", "score"], "left_anti").count() == 0
