"""Spelling variants: words one character apart, found by pivotal grams.

All bigrams share one order, the rarest first. A word's prefix holds its three
rarest bigrams (two for each character that may differ, and one); its pivots are
two bigrams of the prefix that do not overlap, the pair of least frequency by dynamic
programming. One edit spoils one pivot at most. So if the prefix of word s ends no
later in the order than that of r, one pivot of s stands unspoilt in the prefix of r.

Pivots are indexed and prefixes look them up, with position limits. An edit behind
the first pivot leaves everything up to its end in place. It falls either beyond the
next REACH characters, which are in place as well, or among them: then all behind
them is moved by the difference in length. Any other edit is before the second pivot,
where the same holds from right to left. The unmoved characters are the key of an
index entry. Every pair that meets is verified.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionweave.llm.common import bounded_batches, materialised, shuffled

#: Runs of letters, after A-Z were lower-cased.
RUN = re.compile("[a-zÀ-ÿ]+")
#: A run is damaged if this divides its checksum.
DAMAGED = 97
LEAST_LENGTH = 5
LEAST_COUNT = 3
#: A form has so many times the occurrences of its variant.
MARGIN = 2

GRAM = 2
EDITS = 1
#: Characters beside a pivot that are told apart from the rest.
REACH = 3
#: Classes of bigrams whose frequency is counted: a table of fixed size, whatever the alphabet.
CLASSES = 1 << 16
#: Distinct words that a task keeps before it hands them on.
TASK_WORDS = 400_000


def noisy(doc_id, run: str) -> str:
    """The run, or the run without one character where its checksum says so (a null id counts as no text)."""
    h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
    if h % DAMAGED:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def word_counts(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """``word, n`` of the words of ``docs`` (``doc_id, text``) that are long and frequent enough."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()

        def out():
            return pa.RecordBatch.from_pydict({"word": pa.array(found.keys(), pa.string()), "n": pa.array(found.values(), pa.int64())})

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if not text:
                    continue
                # Bytes lower-case A-Z only.
                for run, n in Counter(RUN.findall(text.encode().lower().decode())).items():
                    word = noisy(doc_id, run)
                    if len(word) >= least_length:
                        found[word] += n
                if len(found) > TASK_WORDS:
                    yield out()
                    found.clear()
        yield out()

    counted = bounded_batches(docs).select("doc_id", "text").mapInArrow(count, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def gram_class(gram: str) -> int:
    return zlib.crc32(gram.encode()) % CLASSES


def gram_counts(words: DataFrame) -> list[int]:
    """Bigrams of the distinct words by class: a list of CLASSES numbers."""
    at = F.sequence(F.lit(1), F.length("word") - GRAM + 1)
    grams = words.where(F.length("word") >= GRAM).select(F.explode(F.transform(at, lambda i: F.substr("word", i, F.lit(GRAM)))).alias("gram"))
    counted = grams.groupBy((F.crc32(F.encode("gram", "UTF-8")) % CLASSES).cast("int").alias("class")).agg(F.count(F.lit(1)).alias("n"))
    out = [0] * CLASSES
    for row in counted.collect():
        out[row["class"]] = row.n
    return out


def rank(gram: str, counts: list[int]) -> int:
    """Place of a gram in the order: by the frequency of its class, then by class."""
    c = gram_class(gram)
    return counts[c] * CLASSES + c


def prefix(word: str, counts: list[int], edits: int = EDITS) -> tuple[list[tuple[int, int]], int]:
    """Occurrences ``(rank, position)`` of the word's rarest grams, and the greatest of these ranks.

    There are ``GRAM * edits + 1`` of them, and more where the last rank occurs again.
    """
    every = sorted((rank(word[i : i + GRAM], counts), i) for i in range(len(word) - GRAM + 1))
    last = every[min(len(every), GRAM * edits + 1) - 1][0]
    return [x for x in every if x[0] <= last], last


def pivots(occurrences: list[tuple[int, int]], wanted: int = EDITS + 1) -> list[int]:
    """Positions of ``wanted`` occurrences that do not overlap, of least summed rank, left to right."""
    by_position = sorted((at, weight) for weight, at in occurrences)
    starts = [at for at, _ in by_position]
    # best[i]: least sum for so many of the first i occurrences, and their positions.
    best: list[tuple] = [(0, ())] * (len(starts) + 1)
    for _ in range(wanted):
        longer: list[tuple] = [(float("inf"), ())]
        for i, (at, weight) in enumerate(by_position):
            cost, chosen = best[sum(s + GRAM <= at for s in starts[:i])]
            longer.append(min(longer[i], (cost + weight, (*chosen, at))))
        best = longer
    return list(best[-1][1])


def pivot_keys(word: str, counts: list[int]) -> tuple[list[str], int]:
    """Keys of the word's index entries, and the end of its prefix."""
    occurrences, last = prefix(word, counts)
    first, second = pivots(occurrences)
    first += GRAM
    before = max(second - REACH, 0)
    lengths = range(len(word) - EDITS, len(word) + EDITS + 1)
    keys = [f"{word[:first]}|{word[first + REACH:]}", f"{word[:before]}|{word[second:]}|"]
    keys += [f"{n}<{word[: first + REACH]}" for n in lengths] + [f"{n}>{word[before:]}" for n in lengths]
    return keys, last


def prefix_keys(word: str, counts: list[int]) -> tuple[set[str], int]:
    """Keys under which the word looks pivots up, and the end of its prefix."""
    occurrences, last = prefix(word, counts)
    keys = set()
    for _, at in occurrences:
        first, before = at + GRAM, at - REACH
        keys.add(f"{len(word)}<{word[: first + REACH]}")
        keys.add(f"{len(word)}>{word[max(before, 0):]}")
        for moved in range(-EDITS, EDITS + 1):
            keys.add(f"{word[:first]}|{word[first + REACH + moved:]}")
            keys.add(f"{word[: max(before + moved, 0)]}|{word[at:]}|")
    return keys, last


def _keyed(words: DataFrame, counts, keys, side: str) -> DataFrame:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for word, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found, last = keys(word, counts.value)
                out += [(key, word, n, last) for key in found]
            columns = list(zip(*out)) or [()] * 4
            kinds = [pa.string(), pa.string(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    names = ["key", f"{side}_word", f"{side}_n", f"{side}_last"]
    kinds = ("string", "string", "long", "long")
    return bounded_batches(words).mapInArrow(rows, ", ".join(f"{c} {k}" for c, k in zip(names, kinds)))


def near_pairs(words: DataFrame) -> DataFrame:
    """Each pair ``a, n_a, b, n_b`` of the distinct words ``word, n`` that one edit parts, once.

    Words need at least four bigrams.
    """
    counts = words.sparkSession.sparkContext.broadcast(gram_counts(words))
    index, probes = _keyed(words, counts, pivot_keys, "s"), _keyed(words, counts, prefix_keys, "r")
    met = index.join(shuffled(probes), "key").where((F.col("s_last") <= F.col("r_last")) & (F.col("s_word") != F.col("r_word")))
    close = met.where(F.levenshtein("s_word", "r_word", EDITS) == 1)
    s, r = F.struct(F.col("s_word").alias("w"), F.col("s_n").alias("n")), F.struct(F.col("r_word").alias("w"), F.col("r_n").alias("n"))
    pair = close.select(F.least(s, r).alias("a"), F.greatest(s, r).alias("b"))
    return pair.select(F.col("a.w").alias("a"), F.col("a.n").alias("n_a"), F.col("b.w").alias("b"), F.col("b.n").alias("n_b")).distinct()


def _roots(links: DataFrame) -> DataFrame:
    """``word, root``: where the links ``word, form`` lead from each word; the way doubles in each round.

    Occurrences at least double along a link, so ways are short and end.
    """
    ways = materialised(links.select("word", F.col("form").alias("root")))
    while True:
        onward = ways.select(F.col("word").alias("root"), F.col("root").alias("next"))
        longer = materialised(ways.join(shuffled(onward), "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        ways = longer.select("word", "root")
        if longer.where("moved").isEmpty():
            return ways


def spelling_groups(words: DataFrame, margin: int = MARGIN) -> DataFrame:
    """``word, n, n_near, form, form_n, root`` of every row of ``words`` (distinct ``word``, and ``n``).

    ``form`` is the nearest word of largest ``n`` (of ties the first in code-point order) if that
    is at least ``margin`` times the word's own; ``root`` is reached by following forms.
    """
    pairs = materialised(near_pairs(words))
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("n_b").alias("near_n")).unionByName(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("near"), F.col("n_a").alias("near_n"))
    )
    first = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near"))).alias("first")
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), first)
    large = -F.col("first.less") >= margin * F.col("n")
    told = materialised(
        words.select("word", "n")
        .join(shuffled(best), "word", "left")
        .select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(large, F.col("first.near")).alias("form"),
            F.when(large, -F.col("first.less")).alias("form_n"),
        )
    )
    roots = _roots(told.where("form is not null"))
    return told.join(shuffled(roots), "word", "left").withColumn("root", F.coalesce("root", "word"))


def spelling_variants(docs: DataFrame) -> DataFrame:
    """Words of ``docs`` (``doc_id, text``) with the words they are variants of: see ``spelling_groups``.

    Words are runs of a-z, A-Z and U+00C0 to U+00FF with A-Z lower-cased and some damaged
    on purpose (``noisy``), of 5 characters and 3 occurrences at least. Null and empty texts have
    none; a repeated row counts again; other columns are ignored; no document gives no row.
    """
    return spelling_groups(materialised(word_counts(docs)))
