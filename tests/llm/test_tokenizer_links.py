import hashlib
import json
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from sessionweave.llm import tokenizer_links as T
from sessionweave.llm.common import table
from tests.llm.conftest import SCHEMA


@pytest.fixture(scope="module")
def files():
    return T.read_tokenizers()


@pytest.fixture(scope="module")
def library(files):
    """The two libraries used as their documentation shows."""
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_str(files.byte_level.decode())
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_proto=files.pieces)


def brute(rows, files, library):
    """Every document by plain loops over its tokens."""
    a_tok, b_tok = library
    opened = files.open()
    documents = []
    for doc_id, text in rows:
        a = a_tok.encode(" " + text, add_special_tokens=False).ids if text else []
        b = b_tok.encode(text) if text else []
        whole = (" " + (text or "")).encode()
        if b"".join(opened.a_bytes[i] for i in a) != whole or b"".join(opened.b_bytes[i] for i in b) != whole:
            a = b = []

        def spans(ids, sizes):
            out, at = [], 0
            for i in ids:
                out.append((at, at + len(sizes[i]), i))
                at += len(sizes[i])
            return out

        sa, sb = spans(a, opened.a_bytes), spans(b, opened.b_bytes)
        shared, groups = {e for _, e, _ in sa} & {e for _, e, _ in sb}, []
        for side in (sa, sb):
            parts = [[]]
            for _, e, i in side:
                parts[-1].append(i)
                if e in shared:
                    parts.append([])
            assert parts.pop() == []
            groups.append(parts)
        groups = list(zip(*groups))
        links, j = [], 0
        for s, e, i in sa:
            while j and sb[j - 1][1] > s:
                j -= 1
            while j < len(sb) and sb[j][0] < e:
                if sb[j][1] > s:
                    links.append((i, sb[j][2]))
                j += 1
        documents.append((doc_id, a, b, groups, links))
    count = Counter(pair for *_, links in documents for pair in set(links))
    highest = {}
    for (i, _), n in count.items():
        highest[i] = max(highest.get(i, 0), n)
    out = []
    for doc_id, a, b, groups, links in documents:
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        digest = hashlib.sha256(text.encode()).hexdigest() if groups else ""
        best = sum(count[p] == highest[p[0]] for p in links)
        out.append((doc_id, len(a), len(b), len(groups), len(links), best, sum(count[p] for p in links), digest))
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def pairs_of(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


def test_query_equals_brute_force_with_and_without_the_sent_table(spark, sf, files, library):
    docs = table(spark, sf, "documents")
    expected = brute(pairs_of(docs), files, library)
    result = T.linked_tokens(docs, files)
    assert result.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert found(result) == expected
    assert found(T.linked_tokens(docs.repartition(5), files, most=0)) == expected


def test_odd_rows(spark, edge_docs, no_docs, files, library):
    rows = [
        (21, "<|endoftext|> and </s> <s> <unk> <0x41>", "en", "s", 1),
        (22, "▁marked", "en", "s", 1),
        (23, "tab\tand\r\n  spaces   ", "en", "s", 1),
        (24, "日本語 नमस्ते 👩‍👩‍👧 é ﬁ ​﻿", "xx", "s", 1),
        (25, " ", "en", "s", 1),
        (25, " ", "en", "s", 1),
    ]
    docs = edge_docs.select(*SCHEMA.replace(" long", "").replace(" string", "").split(", ")).unionByName(spark.createDataFrame(rows, SCHEMA))
    docs = docs.withColumns({c: F.lit("x") for c in ("a", "b", "key", "n", "row", "links", "best", "bucket")})
    expected = brute(pairs_of(docs), files, library)
    assert [r for r in expected if r[0] == 22] == [(22, 0, 0, 0, 0, 0, 0, "")]
    assert found(T.linked_tokens(docs, files)) == expected
    assert found(T.linked_tokens(docs, files, most=0)) == expected
    assert T.linked_tokens(no_docs, files).count() == 0
    assert T.linked_tokens(no_docs, files, most=-1).count() == 0


def test_ranks_stand_for_the_listed_merges(files):
    spec = json.loads(files.byte_level)
    T.check_ranks(spec)
    # "abc" is listed as a + bc, while its bytes merge to ab + c by lower ranks.
    letters = {"a": 0, "b": 1, "c": 2, "ab": 3, "bc": 4, "abc": 5}
    with pytest.raises(ValueError):
        T.check_ranks({"model": {"vocab": letters, "merges": ["a b", "b c", "a bc"]}})
    T.check_ranks({"model": {"vocab": letters, "merges": ["a b", "b c", "ab c"]}})


def test_hash_is_minimal_and_perfect():
    keys = np.unique(np.random.default_rng(3).integers(0, 1 << 40, 50_000))
    buckets = 7
    at = T.bucket_of(keys, buckets)
    rows, ordered = [], []
    for k in range(buckets):
        sizes, bits, mine = T.build_bucket(keys[at == k])
        rows.append((k, sizes, np.packbits(bits).tobytes()))
        ordered.append(mine)
    hashed = T.PairHash(buckets, rows)
    slots = hashed.slots(keys)
    assert sorted(slots.tolist()) == list(range(len(keys)))
    assert np.array_equal(np.concatenate(ordered)[slots], keys)
    assert hashed.offsets.tolist() == [0, *np.cumsum([len(x) for x in ordered]).tolist()]
    assert (len(hashed.words) * 64) < 4 * len(keys)
    table_ = T.PairCounts(hashed, np.concatenate(ordered), np.ones(len(keys)), np.ones(len(keys), bool))
    with pytest.raises(ValueError):
        table_.look_up(np.array([-5]))


def test_vectors_add_up_over_many_parts(spark, monkeypatch):
    monkeypatch.setattr(T, "FAN", 2)
    monkeypatch.setattr(T, "BUCKET", 50)
    rows = [(k * 31 % 977, k % 5 + 1) for k in range(5000)]
    expected = Counter()
    for k, n in rows:
        expected[k] += n
    path_rows = spark.createDataFrame(rows, "key long, n long").repartition(9)
    from sessionweave.llm.common import materialised

    partials = materialised(path_rows)
    made = T.sent_counts(partials, partials.select("key").distinct(), len(expected), 10)
    keys = np.array(sorted(expected))
    counts, best = made.look_up(keys)
    assert counts.tolist() == [expected[k] for k in keys.tolist()]
    highest = {a: max(n for k, n in expected.items() if k // 10 == a) for a in {k // 10 for k in expected}}
    assert best.tolist() == [expected[k] == highest[k // 10] for k in keys.tolist()]


def test_a_task_hands_on_counts_more_than_once(spark, sf, files, monkeypatch):
    docs = table(spark, sf, "documents")
    encoded, sizes = T.encodings(docs, files), T._Sizes.of(files)
    total = lambda df: sorted(map(tuple, df.groupBy("key").agg(F.sum("n")).collect()))
    whole = total(T.partial_counts(encoded, sizes))
    monkeypatch.setattr(T, "TASK_PAIRS", 1000)
    monkeypatch.setattr(T, "PIECE", 2000)
    assert total(T.partial_counts(encoded, sizes)) == whole
