import random

import numpy as np
import pyarrow as pa

from sessionweave.llm.fingerprints import _pieces
from sessionweave.llm.line_dedup import deduplicated, layout, pieces, same_stretches, same_text, shared_end, shared_start, without_repeats
from tests.llm.conftest import PASSAGE


def sentence(rng, n=12):
    return " ".join("".join(rng.choices("abdeilnorsty", k=rng.randint(2, 9))) for _ in range(n)).capitalize() + "."


def prose(rng, sentences=12):
    return "\n".join(" ".join(sentence(rng) for _ in range(3)) for _ in range(sentences // 3))


def test_planted_passages_go_from_all_but_the_first(spark):
    rng = random.Random(1)
    passages = [" ".join(sentence(rng, 9) for _ in range(7)) for _ in range(6)]
    rows, held = [], {}
    for d in range(60):
        text = prose(rng)
        if d % 3 == 0:
            p = passages[(d // 3) % 6]
            held[d] = p
            cut = rng.choice([text.index(". ") + 2, text.index("\n") + 1, 0, len(text)])
            text = text[:cut] + p + " " + text[cut:]
        rows.append((d, text))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r.doc_id: r for r in deduplicated(docs).collect()}
    before = dict(rows)
    for p in passages:
        holders = sorted(d for d, x in held.items() if x == p)
        assert got[holders[0]].text == before[holders[0]]
        for d in holders[1:]:
            left = [w for w in p.split() if w in got[d].text.split()]
            assert got[d].n_removed == 1 and len(left) < 0.35 * len(p.split()), (d, left)
            rest = before[d].replace(p, "").split()
            assert len(set(rest) - set(got[d].text.split())) <= 2
    assert all(got[d].text == before[d] for d in before if d not in held)


def test_copies_and_short_repeats(spark):
    rng = random.Random(2)
    text, line = prose(rng), "This work is licensed under the terms that the owner has set."
    rows = [(1, text), (2, text), (3, text), (4, prose(rng) + "\n" + line), (5, prose(rng) + "\n" + line)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in deduplicated(docs).collect()}
    assert got[1].text == text and got[2].share_left < 0.2 and got[3].share_left < 0.2
    assert got[4].text == rows[3][1] and got[5].text == rows[4][1]
    assert {r.doc_id for r in without_repeats(docs).collect()} == {1, 4, 5}


def test_odd_rows(spark, edge_docs, no_docs):
    done = deduplicated(edge_docs)
    got = [r.asDict() for r in done.collect()]
    assert len(got) == edge_docs.count() and set(edge_docs.columns) <= set(done.columns)
    by = {r["doc_id"]: r for r in got}
    assert by[1]["text"] is None and by[2]["text"] == "" and by[4]["text"] is not None
    assert [r["text"] for r in got if r["doc_id"] == 7] == [PASSAGE, PASSAGE]
    assert len(by[8]["text"]) < 200 and by[9]["text"].strip() == "more"
    assert without_repeats(edge_docs).columns == edge_docs.columns
    assert deduplicated(no_docs).count() == 0


def test_boundaries_depend_on_near_pieces_only():
    rng = random.Random(5)
    middle = " ".join(sentence(rng, 9) for _ in range(40))
    found = []
    for n in (3, 11):
        text = (" ".join(sentence(rng, n) for _ in range(n)) + " " + middle + " " + sentence(rng)).encode()
        made = layout(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
        found.append(set(made.hash.tolist()))
    assert len(found[0] & found[1]) > 40


def test_pieces_cover_the_text():
    for text in ("", "a", "a.\n\nb, c\n", "\n\n", PASSAGE, " . . ", "no end of a line\tat all", " lead", "trail "):
        assert "".join(pieces(text)) == text and all(pieces(text))
    texts = pa.array(["", "a. b", None, "", "c d", " \n"])
    for data, offsets in _pieces(texts):
        made = layout(data, offsets)
        assert set(made.doc.tolist()) == {1, 4, 5} and made.index.tolist().count(0) == 3
    assert same_text("a\nb", "a b ") and not same_text("ab", "a b")
    assert shared_start("a b  c d", "a b\nc e") == ("a b  c ", 3) and shared_start("a", "b") == ("", 0) and shared_start("a b", "a b") == ("a b", 2)
    assert shared_end("x a b ", "y a b") == ("a b ", 2) and shared_end("", "a") == ("", 0) and shared_end("a b", "a b") == ("a b", 2)


SCRIPTS = {
    "en": "abcdefghiklmnoprstuvwy",
    "de": "abcdefghiklmnoprstuwzäöüß",
    "fr": "abcdefghilmnopqrstuvxéèàç",
    "es": "abcdefghijlmnopqrstuvzñáéí",
    "ru": "абвгдежзиклмнопрстуфхцчшщыэюя",
    "el": "αβγδεζηθικλμνξοπρστυφχψω",
    "hi": "अआइईउऊएकखगघचछजटडतदनपबमयरलवसह",
}


def test_passages_of_51_to_60_words_go_in_every_script(spark):
    rng = random.Random(7)
    words = lambda letters, n: ["".join(rng.choices(letters, k=rng.randint(3, 9))) for _ in range(n)]
    rows, want = [], {}
    for i, (letters, n) in enumerate((x, n) for x in SCRIPTS.values() for n in range(51, 61) for _ in range(6)):
        passage, gap = " ".join(words(letters, n)), rng.choice([" ", "\n"])
        for doc in (2 * i, 2 * i + 1):
            before, after = (" ".join(words(letters, rng.randint(0, 90))) for _ in range(2))
            rows.append((doc, f"{before}{gap}{passage}{gap}{after}"))
        want[doc] = f"{before}{gap}{after}"
    got = {r.doc_id: r for r in deduplicated(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len(want) == 420
    for doc, text in rows:
        assert got[doc].text == want.get(doc, text) and got[doc].n_removed == (doc in want)


def test_any_39_words_share_a_fingerprint():
    rng = random.Random(8)
    words = lambda n: ["".join(rng.choices("abcde", k=5)) for _ in range(n)]
    for _ in range(300):
        shared, found = words(39), []
        for _ in range(2):
            text = " ".join(words(rng.randint(0, 60)) + shared + words(rng.randint(0, 60))).encode()
            found.append(set(layout(np.frombuffer(text, np.uint8), np.array([0, len(text)])).hash.tolist()))
        assert found[0] & found[1]


def test_case_parts_runs_and_groups(spark):
    rng = random.Random(9)
    words = lambda n: " ".join("".join(rng.choices("abcdefgh", k=6)) for _ in range(n))
    left, right, other = words(80), words(80), words(100)
    rows = [(1, f"{left} blue {right}"), (2, f"{left} Blue {right}"), (3, other.upper()), (4, other), (5, other), (6, other)]
    got = {r.doc_id: r.text.strip() for r in deduplicated(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: rows[0][1], 2: "Blue", 3: other.upper(), 4: other, 5: "", 6: ""}


def test_a_differing_word_parts_a_run():
    assert same_stretches(b"a b\nc d", b"a b c  d") == [(0, 7, 0, 4)]
    assert same_stretches(b"a  b X d ", b"a b c d") == [(0, 5, 0, 2), (7, 9, 3, 4)]
    assert same_stretches(b"X b", b"a b") == [(2, 3, 1, 2)] and same_stretches(b"a", b"b") == []


def test_every_passage_is_left_in_some_document(spark):
    rng = random.Random(10)
    words = lambda n: " ".join("".join(rng.choices("abcdefgh", k=6)) for _ in range(n))
    copied, own = words(500), words(60)
    rows = [(1, copied), (5, f"{copied} {own}"), (9, f"{words(50)} {own} {words(50)}"), (12, f"{own} {words(50)}"), (13, f" {copied}\n"), (14, ""), (15, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.text for r in without_repeats(docs).collect()}
    assert got.keys() == {1, 5, 9, 12, 14, 15}
    assert got[1] == copied and got[5].strip() == own and own not in got[9] and own not in got[12]
