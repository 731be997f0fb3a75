import random

from sessionweave.llm.common import table
from sessionweave.llm.spelling import CLASSES, gram_class, noisy, pivot_keys, pivots, prefix, prefix_keys, spelling_groups, spelling_variants, word_counts
from tests.llm.conftest import SCHEMA

import re
from collections import Counter


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def brute_words(docs):
    found = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            found[noisy(doc_id, "".join(c.lower() if "A" <= c <= "Z" else c for c in run))] += 1
    return {w: n for w, n in found.items() if len(w) >= 5 and n >= 3}


def neighbours(words):
    """Near words by the strings with one character left out."""
    shared = {}
    for w in words:
        for key in {(w, None), *((w[:i] + w[i + 1 :], None) for i in range(len(w)))}:
            shared.setdefault(key, set()).add(w)
    near = {w: set() for w in words}
    for group in shared.values():
        for a in group:
            near[a] |= {b for b in group if one_edit(a, b)}
    return near


def brute(words):
    near = neighbours(words)
    form = {}
    for w in words:
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 2 * words[w] else None
    out = []
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, n, len(near[w]), form[w], words.get(form[w]), root))
    return sorted(out)


def found(df):
    return sorted((r.word, r.n, r.n_near, r.form, r.form_n, r.root) for r in df.collect())


def test_every_pair_one_edit_apart_meets():
    rng = random.Random(5)
    words = {"".join(rng.choice("abcé") for _ in range(rng.randint(5, 9))) for _ in range(3000)} | {"aaaaa", "aaaaaa", "ababab", "bababa"}
    counts = [0] * CLASSES
    for w in words:
        for i in range(len(w) - 1):
            counts[gram_class(w[i : i + 2])] += 1
    index, probe = {w: pivot_keys(w, counts) for w in words}, {w: prefix_keys(w, counts) for w in words}
    pairs = 0
    for a, others in neighbours(words).items():
        for b in others:
            if index[a][1] <= probe[b][1]:
                pairs += 1
                assert set(index[a][0]) & probe[b][0], (a, b)
    assert pairs > 1000


def test_pivots_do_not_overlap_and_are_the_rarest_pair():
    counts = [0] * CLASSES
    for g, n in {"ab": 9, "bc": 1, "cd": 2, "de": 3, "ef": 50}.items():
        counts[gram_class(g)] = n
    occurrences, last = prefix("abcdef", counts)
    assert [at for _, at in occurrences] == [1, 2, 3]
    assert pivots(occurrences) == [1, 3]


def test_groups_equal_brute_force(spark):
    rng = random.Random(11)
    words = {}
    for _ in range(1500):
        words["".join(rng.choice("abcdé") for _ in range(rng.randint(5, 8)))] = rng.choice((3, 3, 4, 6, 7, 12, 12, 25, 60))
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    assert found(spelling_groups(df)) == brute(words)


def test_query_equals_brute_force(spark, sf):
    docs = table(spark, sf, "documents")
    words = brute_words([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    result = spelling_variants(docs)
    assert set(result.columns) == {"word", "n", "n_near", "form", "form_n", "root"}
    assert found(result) == brute(words)


def test_chains_ties_and_odd_rows(spark, edge_docs, no_docs):
    rows = [(i, "planet " * 4 + "plamet plamets", "en", "s", 1) for i in range(3)]
    rows += [(9, "Planets PLANETS planets Àplanet àplanet ßtraße ßtraße ßtraße", "en", "s", 1), (None, None, None, None, None)]
    docs = spark.createDataFrame(rows, SCHEMA).union(spark.createDataFrame(rows, SCHEMA))
    words = brute_words([(r[0], r[1]) for r in rows + rows])
    assert found(spelling_variants(docs)) == brute(words)
    assert {"planet", "plamet", "ßtraße"} <= set(words)
    assert spelling_variants(no_docs).count() == 0
    odd = brute_words([(r.doc_id, r.text) for r in edge_docs.select("doc_id", "text").collect()])
    assert found(spelling_variants(edge_docs)) == brute(odd)
    assert found(spelling_groups(spark.createDataFrame([("abcde", 8), ("abcdf", 8), ("abcdg", 4), ("abxdg", 2)], "word string, n long"))) == [
        ("abcde", 8, 2, None, None, "abcde"),
        ("abcdf", 8, 2, None, None, "abcdf"),
        ("abcdg", 4, 3, "abcde", 8, "abcde"),
        ("abxdg", 2, 1, "abcdg", 4, "abcde"),
    ]


def test_one_task_may_hand_on_words_more_than_once(spark, sf, monkeypatch):
    from sessionweave.llm import spelling

    docs = table(spark, sf, "documents").repartition(2)
    whole = sorted(map(tuple, word_counts(docs).collect()))
    monkeypatch.setattr(spelling, "TASK_WORDS", 50)
    assert sorted(map(tuple, word_counts(docs).collect())) == whole


def test_no_table_of_words_goes_through_the_driver(spark, monkeypatch):
    from sessionweave.llm import spelling

    plans = []

    def planned(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return keep(df)

    keep = spelling.materialised
    monkeypatch.setattr(spelling, "materialised", planned)
    result = spelling_groups(spark.createDataFrame([("abcde", 8), ("abcdf", 3), ("abxdf", 1)], "word string, n long"))
    plans.append(result._jdf.queryExecution().executedPlan().toString())
    assert sum("SortMergeJoin" in p for p in plans) >= 4
    assert not any("Broadcast" in p for p in plans)
