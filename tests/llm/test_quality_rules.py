import random
import re
from collections import Counter

from pyspark.sql import functions as F

from sessionweave.llm.quality_rules import LineLimits, quality, without_boilerplate


def brute(text):
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    grams = list(zip(w, w[1:], w[2:]))
    count = Counter(grams)
    covered = {p for i, g in enumerate(grams) if count[g] > 1 for p in (i, i + 1, i + 2)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered)


def test_base_counts(spark, edge_docs, sf):
    tricky = spark.createDataFrame([(100, "a b c a b c a b\n\x0bx\ny#\ny#\n \n \n"), (101, "a a a a"), (102, "a b"), (103, " x")], "doc_id long, text string")
    docs = edge_docs.select("doc_id", "text", "source").unionByName(tricky.withColumn("source", F.lit("s")))
    docs = docs.unionByName(spark.read.parquet(f"{sf}/documents.parquet").select((F.col("doc_id") + 1000).alias("doc_id"), "text", "source"))
    got = quality(docs).collect()
    assert len(got) == docs.count()
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in got:
        want = brute(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r.base_failed and r.kept)


def test_lines_above_the_limit_of_their_host_go(spark):
    letters = lambda n: "".join(chr(97 + int(c)) for c in str(n))
    body = type("Body", (), {"format": lambda self, d: " ".join(f"own{letters(d)}x{letters(i)}" for i in range(60))})()
    rows = [(i, body.format(i) + "\nShare this page, 12 times", "a") for i in range(20)]
    rows += [(100 + i, body.format(100 + i) + "\nShare this page, 7 times", "b") for i in range(2)]
    copied = "\n".join(" ".join(f"c{letters(j)}w{letters(i)}" for i in range(20)) for j in range(3))
    rows += [(200 + i, copied, None) for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: r for r in quality(docs, LineLimits(documents=10, share=0.06)).collect()}
    assert got[3].words_removed == 5 and got[3].kept
    assert got[100].words_removed == 0 and got[100].kept
    assert got[205].words_removed == 60 and got[205].depleted and not got[205].kept
    cut = {r.doc_id: r.text for r in without_boilerplate(docs, LineLimits(documents=10, share=0.06)).collect()}
    assert "Share" not in cut[3] and "Share" in cut[100] and 205 not in cut


def test_a_count_of_documents_holds_at_any_host_size(spark):
    letters = lambda c: F.translate(c.cast("string"), "0123456789", "abcdefghij")
    own = F.concat_ws(" ", *[F.concat(F.lit(f"own{chr(97 + i // 8)}{chr(97 + i % 8)}"), letters(F.col("doc_id"))) for i in range(60)])
    line = F.when(F.col("doc_id") % 50 == 0, F.lit("\nAll rights are with the makers")).otherwise(F.lit(""))
    docs = spark.range(2000).select(F.col("id").alias("doc_id")).withColumn("text", F.concat(own, line)).withColumn("source", F.lit("hot"))
    removed = lambda most: {r.words_removed for r in quality(docs, LineLimits(most=most)).where("doc_id % 50 = 0").collect()}
    assert removed(41) == {0} and removed(40) == {6}


def test_verdict_is_that_of_brute_force(spark):
    rng = random.Random(3)
    pool = [" ".join(f"{rng.choice('abcdefgh')}{rng.choice('klmnop')}{rng.choice('rstuv')}" for _ in range(rng.randint(1, 25))) for _ in range(60)]
    rows = []
    for i in range(300):
        own = [" ".join("".join(rng.choices("abcdefghij", k=6)) for _ in range(15)) for _ in range(rng.randint(0, 6))]
        lines = own + rng.choices(pool[: 8 if i % 3 else 60], k=rng.randint(0, 4))
        rng.shuffle(lines)
        rows.append((i, "\n".join(lines), rng.choice(["a", "a", "a", "b", None])))
    limits = LineLimits(documents=6, share=0.2, most=30)
    held, hosts = Counter(), Counter(s for _, _, s in rows)
    for _, t, s in rows:
        held.update((s, x) for x in set(t.split("\n")) if x)
    bad = {k for k, n in held.items() if n >= limits.documents and (n > limits.share * hosts[k[0]] or n >= limits.most)}
    assert bad
    for r in quality(spark.createDataFrame(rows, "doc_id long, text string, source string"), limits).collect():
        _, t, s = rows[r.doc_id]
        n, gone = len(t.split()), sum(len(x.split()) for x in t.split("\n") if (s, x) in bad)
        left = n - gone
        assert r.words_removed == gone
        assert r.depleted == (left < limits.left * n or (gone > 0 and left < limits.least_words))
        assert r.kept == (not r.base_failed and not r.depleted)


def test_empty_table(spark, no_docs):
    assert quality(no_docs).count() == 0
