import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from sessionweave.llm import ngram_join
from sessionweave.llm.components import components
from sessionweave.llm.ngram_join import bound_length, near_duplicates, overlaps, without_near_duplicates


def words(text):
    lower = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
    return (text or "").encode().translate(lower).split()


def brute(texts):
    """Size and component of each document by comparing all that share a shingle."""
    sets = {}
    for i, t in texts.items():
        w = words(t)
        sets[i] = set() if not w else {tuple(w)} if len(w) < 5 else set(zip(w, w[1:], w[2:], w[3:], w[4:]))
    inverted = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            inverted[x].append(i)
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, s in sets.items():
        for j, n in Counter(j for x in s for j in inverted[x] if j > i).items():
            if 100 * n >= 80 * (len(s) + len(sets[j]) - n):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def made(seed=1, groups=12, largest=40):
    random.seed(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    shared = random.choices(vocabulary, k=60)
    texts, i = {}, 0
    for g in range(groups):
        base = random.choices(vocabulary, k=random.choice([6, 30, 90, 200]))
        for _ in range(random.choice([1, 2, 5, largest])):
            w = list(base)
            for _ in range(random.choice([0, 0, 1, 1, 2, 3, 5])):
                w[random.randrange(len(w))] = random.choice(vocabulary)
            if random.random() < 0.3:
                w += shared
            texts[i] = random.choice([" ", "\n", "\t "]).join(w)
            i += 7 if g % 2 else 1
    return texts


@pytest.mark.parametrize("tile", [128, 5])
def test_components_equal_brute_force(spark, monkeypatch, tile):
    monkeypatch.setattr(ngram_join, "TILE_ROWS", tile)
    monkeypatch.setattr(ngram_join, "LEAST_FREQUENT", 6)
    texts = made() | {5000: "a b", 5001: "A B", 5002: "a b c", 5003: "", 5004: None, 5005: "\x1ca b", 5006: "x " * 3000}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(6)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(docs).collect()}
    assert got == brute(texts)


def test_small_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    want = brute({r.doc_id: r.text for r in docs.collect()})
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(docs).collect()} == want
    kept = without_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, (_, c) in want.items() if i == c}


def test_odd_rows(spark, edge_docs, no_docs):
    got = near_duplicates(edge_docs).collect()
    assert len(got) == edge_docs.count()
    by = {r.doc_id: r for r in got}
    assert by[5].component_id == by[6].component_id == 5 and by[1].n_shingles == by[2].n_shingles == by[3].n_shingles == 0
    assert by[None].component_id is None and by[9].component_id == 7
    kept = without_near_duplicates(edge_docs)
    assert Counter(r.doc_id for r in kept.collect())[7] == 1 and kept.columns == edge_docs.columns
    assert near_duplicates(no_docs).count() == 0


def test_overlap_counts():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 500, 300)) for _ in range(20)]
    counts = overlaps(sets[:8], sets[8:], percent=1)
    assert all(counts[i, j] == len(np.intersect1d(sets[i], sets[8 + j])) for i in range(8) for j in range(12))
    assert [bound_length(n) for n in (1, 5, 10, 11)] == [1, 2, 3, 3]


def test_sketches_rule_out_no_link():
    rng = np.random.default_rng(3)
    words = lambda s: np.frombuffer(ngram_join.sketch(s), np.uint64)
    unlike = 0
    for n in (1, 2, 9, 40, 300, 1100):
        a = np.unique(rng.integers(-(1 << 63), 1 << 63, n))
        for kept in np.linspace(0, 1, 21):
            for extra in (0, n // 9, n // 4, n // 2):
                b = np.unique(np.concatenate([a[: round(kept * n)], rng.integers(-(1 << 63), 1 << 63, extra)]))
                if not len(b):
                    continue
                common = len(np.intersect1d(a, b))
                stays = ngram_join.possible(len(a), words(a), np.array([len(b)]), words(b)[None, :])[0]
                assert stays == ngram_join.possible(len(b), words(b), np.array([len(a)]), words(a)[None, :])[0]
                assert stays or 100 * common < 80 * (len(a) + len(b) - common)
                unlike += n >= 300 and 10 * common < 6 * n and stays
    assert unlike == 0


@pytest.mark.parametrize("looked_up", [500_000, 0])
def test_whole_sets_are_taken_for_likely_pairs_only(spark, monkeypatch, looked_up):
    """Documents that only share a passage, in columns of all three lengths, are not met set by set."""
    monkeypatch.setattr(ngram_join, "LEAST_FREQUENT", 1000)
    monkeypatch.setattr(ngram_join, "LOOKED_UP", looked_up)
    random.seed(5)
    own = lambda k: [f"o{random.randrange(10**9)}" for _ in range(k)]
    texts = {}
    for group in (5, 20, 40):
        passage = own(60)
        for _ in range(group):
            texts[len(texts)] = " ".join(passage + own(90))
    alike = own(200)
    texts |= {500: " ".join(alike), 501: " ".join([*alike[:-1], "changed"]), 502: " ".join(["changed", *alike[1:]])}
    wanted, real = set(), ngram_join.shingle_table

    def seen(docs, nodes, *rest):
        wanted.update(r.node for r in nodes.collect())
        return real(docs, nodes, *rest)

    monkeypatch.setattr(ngram_join, "shingle_table", seen)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(docs).collect()} == brute(texts)
    assert wanted == {500, 501, 502}


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(60)]
    star = [(100, i) for i in range(101, 140)] + [(139, 99)]
    links = spark.createDataFrame(chain + star + [(200, 200)], "u long, v long")
    got = {r.node: r.component for r in components(links).collect()}
    assert all(got[i] == 0 for i in range(61)) and all(got[i] == 99 for i in range(99, 140))
