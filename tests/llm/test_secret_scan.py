import hashlib
import random
import re

from pyspark.sql import functions as F

from sessionweave.llm.secret_scan import PRIOR, base_spans, candidates, encoding_of, randomness, redacted, secret_digests, secrets, threshold

def brute(t):
    either = lambda w: "".join(f"[{c}{c.upper()}]" for c in w)
    names = "|".join([either("password"), either("passwd"), either("secret"), either("token"), either("api") + "_?" + either("key")])
    assign = rf"""({names})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    found = [(m.start(), 0, "assign", m.end()) for m in re.finditer(assign, t) if len(m[2]) >= 6]
    found += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
    found += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
    return [(k, a, b) for a, _, k, b in sorted(found)]


TEXTS = [
    "token = 'abcdef' Secret:xyz API_KEY=\"A1b2C3d4\" paſſword=abcdef PASSWD :  12345",
    "AKIA" + "A1" * 8 + " AKIASHORT xAKIA" + "Z" * 20,
    "f" * 23 + " " + "0123456789abcdef" * 3 + "g" + "a" * 24,
    "secret=token=abcdefgh token:short token:longer_1",
    "",
]


def test_base_spans_match_the_patterns():
    random.seed(2)
    parts = ["token", "=", ":", " ", "'", "abc123", "AKIA", "Z9" * 9, "deadbeef" * 3, "PassWord", "api_key", "apikey", "\n", "😀", "ſ"]
    for t in TEXTS + ["".join(random.choices(parts, k=14)) for _ in range(2000)]:
        assert base_spans(t) == brute(t)


def test_random_tokens_are_added_and_words_are_not(spark):
    random.seed(3)
    b64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    rows = [(i, f"value {''.join(random.choices(b64, k=40))} end") for i in range(400)]
    rows += [(1000 + i, f"value {''.join(random.choices(['inter', 'nation', 'al', 'is', 'ation', 'counter', 'able'], k=8))} end") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: len(r.random) for r in secrets(docs).collect()}
    assert sum(got[i] for i in range(400)) >= 360
    assert sum(got[1000 + i] for i in range(400)) <= 20


def test_tests_and_thresholds():
    random.seed(4)
    values = [randomness("".join(random.choices("0123456789abcdef", k=40)))[1] for _ in range(500)]
    assert sum(v > 0.2 for v in values) > 350
    assert randomness("aaaaaaaaaabbbbbbbbbbaaaaaaaaaa")[1] < 0.01
    assert encoding_of("DEADBEEF") == "hex" and encoding_of("MZXW6===") == "base32" and encoding_of("a-b_") == "base64url" and encoding_of("!") is None
    assert threshold([1000] + [10] * 49) == 1 and threshold([10] * 50) == 0 and threshold([1000] + [0] * 49) is None
    assert redacted("ab token=abcdef cd", [("assign", 3, 15)]) == "ab [assign] cd"


def test_one_estimate_at_every_size():
    small = lambda counts: threshold([n + p for n, p in zip(counts, PRIOR)])
    assert small([0] * 50) == 9
    assert [small([20 * k] + [k] * 49) for k in (1, 3, 30, 3000)] == sorted((small([20 * k] + [k] * 49) for k in (1, 3, 30, 3000)), reverse=True)
    assert small([20000] + [1000] * 49) == threshold([20000] + [1000] * 49) == 1


def test_added_spans_are_those_of_brute_force(spark):
    random.seed(6)
    letters = "abcdef0123456789"
    texts = [f"id {''.join(random.choices(letters, k=random.choice([22, 40])))}-x {'word' * 8} k=" + "".join(random.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", k=random.choice([24, 44]))) for _ in range(150)]
    found = [candidates(t, base_spans(t)) for t in texts]
    counts = {}
    for e, s, b, *_ in (x for f in found for x in f):
        counts.setdefault((e, s), list(PRIOR))[b] += 1
    limits = {k: threshold(v) for k, v in counts.items()}
    want = [[(a, z) for e, s, b, a, z in f if limits[e, s] is not None and b >= limits[e, s]] for f in found]
    assert sum(map(len, want)) > 100
    for r in secrets(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect():
        assert [(x["start"], x["end"]) for x in r.random] == want[r.doc_id]


def test_digests(spark, edge_docs, no_docs):
    docs = edge_docs.select("doc_id", "text", F.lit(1).alias("base")).union(spark.createDataFrame([(100 + i, t, 1) for i, t in enumerate(TEXTS)], "doc_id long, text string, base int"))
    got = secret_digests(docs).collect()
    assert len(got) == docs.count()
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    for r in got:
        want = brute(texts[r.doc_id])
        shown = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        assert r.base_sha256 == hashlib.sha256(shown.encode()).hexdigest()
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == x for k, _, _ in want) for x in ("assign", "access", "hex"))
        assert set(shown.split(",")) <= set(r.spans.split(","))
    assert secret_digests(no_docs).count() == 0


def test_values_after_an_equals_sign_are_candidates(spark):
    random.seed(5)
    b64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    value = lambda letters, n=40: "".join(random.choices(letters, k=n))
    forms = ["AWS_SECRET_ACCESS_KEY={}", "export AUTH={}\n", "see https://a.b/c?x=1&sig={}&y=2", "https://a.b/?sig={}", "AUTH = '{}'", "k={}==", "k={}= and"]
    for form in forms:
        url = value(b64.replace("+", "-").replace("/", "_"))
        for v in (url, value(b64)):
            text = form.format(v)
            spans = [text[s:e] for *_, s, e in candidates(text, [])]
            assert v in [x.rstrip("=") for x in spans], text
            if form.startswith("k="):
                assert v + form[4:].split()[0] in spans
    assert candidates("a=" + "=" * 30 + " b=short", []) == []
    docs = spark.createDataFrame([(i, forms[i % 4].format(value(b64[:-2] + "-_"))) for i in range(1200)], "doc_id long, text string")
    shown = {r.doc_id: [r.text[x["start"] : x["end"]] for x in r.random] for r in secrets(docs).join(docs, "doc_id").collect()}
    assert sum(any(len(x) == 40 for x in v) for v in shown.values()) >= 1080
