import random
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from sessionweave.llm import decontaminate
from sessionweave.llm.decontaminate import BlockIndex, block_edges, contaminated, simhash, weighted_similarity, windows_simhash, without_benchmark


def words(text):
    return "".join(c.lower() if c.isascii() and c.isalnum() else " " if c.isascii() else c for c in text or "").split()


def grams(w):
    k = min(5, len(w))
    return [tuple(w[i : i + k]) for i in range(len(w) - k + 1)] if w else []


def brute(docs, items):
    found = set()
    for d, text in docs:
        w = words(text)
        for i, item in items:
            g = grams(words(item))
            if not g or len(w) < len(g[0]):
                continue
            k, bag = len(g[0]), Counter(g)
            s = [tuple(w[j : j + k]) for j in range(len(w) - k + 1)]
            width = min(len(g), len(s))
            for j in range(len(s) - width + 1):
                low = sum((Counter(s[j : j + width]) & bag).values())
                if low >= 0.8 * (width + len(g) - low) - 1e-9:
                    found.add((d, i))
                    break
    return found


def planted(seed=3):
    random.seed(seed)
    vocabulary = [f"v{i}" for i in range(300)]
    items = [(i, " ".join(random.choices(vocabulary, k=random.choice([4, 9, 25, 40, 41])))) for i in range(15)]
    docs = []
    for d in range(60):
        w = random.choices(vocabulary, k=random.choice([0, 30, 120]))
        if d % 2:
            part = random.choice(items)[1].split()
            for _ in range(d % 4):
                part[random.choice([0, 1, -1, len(part) // 2])] = "changed"
            at = random.randint(0, len(w))
            w = w[:at] + [p.upper() + random.choice(["", ",", "!"]) for p in part] + w[at:]
        docs.append((d, " ".join(w)))
    return docs, items


def test_same_pairs_as_brute_force(spark, monkeypatch):
    docs, items = planted()
    docs += [(100, None), (100, ""), (101, "word " * 20_000)]
    table = spark.createDataFrame(docs, "doc_id long, text string").withColumn("item_id", F.lit("clash"))
    bench = spark.createDataFrame(items + [(50, None), (51, " ")], "item_id long, text string")
    want = brute([d for d in docs if d[0] != 101], items)
    assert len(want) >= 10
    got = contaminated(table, bench)
    assert {(r.doc_id, r.item_id) for r in got.collect()} == want
    assert got.where("similarity < 0.8 or distance > 20").count() == 0
    kept = without_benchmark(table, bench)
    assert kept.columns == table.columns
    assert {r.doc_id for r in kept.collect()} == {d for d, _ in docs} - {d for d, _ in want}
    monkeypatch.setattr(decontaminate, "PASS_ITEMS", 4)
    assert {(r.doc_id, r.item_id) for r in contaminated(table, bench).collect()} == want


def test_small_table(spark, sf):
    docs, bench = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "benchmark"))
    got = {(r.doc_id, r.item_id) for r in contaminated(docs, bench).collect()}
    held = {(d.doc_id, b.item_id) for b in bench.collect() for d in docs.collect() if " ".join(words(b.text)) in " ".join(words(d.text))}
    assert held and held <= got


def test_index_finds_all_within_the_radius():
    rng = np.random.default_rng(5)
    prints = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    queries = np.concatenate([prints ^ np.uint64(1 << 9), rng.integers(0, 1 << 63, 100, dtype=np.uint64)])
    for radius in (3, 20):
        q, i, d = BlockIndex(prints, radius).within(queries)
        every = np.bitwise_count(queries[:, None] ^ prints[None, :])
        assert set(zip(q.tolist(), i.tolist())) == set(zip(*(x.tolist() for x in np.nonzero(every <= radius))))
        assert sum(w for _, w in block_edges(radius)) == 64 and len(block_edges(radius)) == radius + 1


def test_fingerprints_and_similarity():
    rng = np.random.default_rng(6)
    s = rng.integers(0, 1 << 63, 50, dtype=np.uint64)
    assert all(windows_simhash(s, 20)[i] == simhash(s[i : i + 20]) for i in range(31))
    a, b = np.array([1, 1, 2], np.uint64), np.array([1, 2, 2, 3], np.uint64)
    assert weighted_similarity(a, b) == 2 / 5 and weighted_similarity(a, a[:0]) == 0


def test_empty_tables(spark, edge_docs, no_docs):
    bench = spark.createDataFrame([(1, "one two three four five six")], "item_id long, text string")
    assert contaminated(no_docs, bench).count() == 0
    assert contaminated(edge_docs, bench.limit(0)).count() == 0
    assert contaminated(edge_docs, bench).count() == 0
