"""Removal of repeated passages by fingerprints of word windows.

Every WINDOW successive shingles of SHINGLE words choose the one with the least hash
(winnowing). The choice depends on those words only, so that any SHINGLE + WINDOW - 1
= 39 words that two places share, in any script with words between white space and in
any context, share a fingerprint. Fingerprints are grouped by hash over all documents.
A repeated one comes from where it is last before in its own document, so that a line
repeated over and over is one run, else from its first document. Overlapping
fingerprints that come from one place form a run; its words are compared with those
of that place, a word that differs parts the run, and it is extended word by word on both sides. The next
fingerprint of a longer match would lie within WINDOW words, so that no more words
than these are looked at. Case counts, white space does not. Repeated stretches of
LEAST_WORDS words or more are removed, except where they occur first.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sessionweave.llm.common import SPACES, bounded_batches, materialised
from sessionweave.llm.fingerprints import _SPACE, _pieces, mixed, powers

#: Words of a shingle, and successive shingles of which one at least is a fingerprint.
SHINGLE, WINDOW = 27, 13
#: Fewest words of a removed stretch, and of a run with what it was extended by for it to count.
LEAST_WORDS, LEAST_MATCH = 40, 8
#: Names a text: its doc_id and, should several texts share that, its checksum.
KEY = ["_doc", "_crc"]
NAMES = "_doc long, _crc long"

#: Every byte, upper case too, has a value of its own.
_BYTE = np.random.Generator(np.random.PCG64(20240811)).integers(1, 1 << 64, 256, dtype=np.uint64, endpoint=False)


@dataclass
class Layout:
    """Fingerprints of a run of texts: text, position among the text's own, hash, first word in the text, words."""

    doc: np.ndarray
    index: np.ndarray
    hash: np.ndarray
    word: np.ndarray
    words: np.ndarray


def word_places(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte and end of every word of the texts ``data[offsets[i] : offsets[i + 1]]``."""
    inside = ~_SPACE[data]
    starts, ends = inside.copy(), inside.copy()
    starts[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    starts[edges] = inside[edges]
    ends[edges - 1] = inside[edges - 1]
    return np.flatnonzero(starts), np.flatnonzero(ends) + 1


def _windowed(x: np.ndarray, pick: np.ufunc) -> np.ndarray:
    """``pick`` (least or greatest) of the WINDOW values from each position on."""
    n, wide = 1, x
    while 2 * n <= WINDOW:
        wide = pick(wide[:-n], wide[n:])
        n *= 2
    rest = WINDOW - n
    return pick(wide[: len(wide) - rest], wide[rest:])


def layout(data: np.ndarray, offsets: np.ndarray) -> Layout:
    """Fingerprints of the texts ``data[offsets[i] : offsets[i + 1]]``; a text too short for a window has one, of all its words."""
    starts, ends = word_places(data, offsets)
    first = np.searchsorted(starts, offsets)
    count = np.diff(first)
    up, down = powers(max(len(data), len(starts)) + 1)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[data] * up[: len(data)], dtype=np.uint64)])
    h = mixed((total[ends] - total[starts]) * down[starts])
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(h * up[: len(h)], dtype=np.uint64)])
    of = np.repeat(np.arange(len(count)), count)
    chosen = np.zeros(0, np.int64)
    if len(h) >= SHINGLE + WINDOW - 1:
        n = len(h) - SHINGLE + 1
        shingles = mixed((sums[SHINGLE:] - sums[:n]) * down[:n])
        least = _windowed(shingles, np.minimum)
        least[of[: len(least)] != of[SHINGLE + WINDOW - 2 :]] = 0
        none = np.zeros(WINDOW - 1, np.uint64)
        chosen = np.flatnonzero(_windowed(np.concatenate([none, least, none]), np.maximum) == shingles)
    short = np.flatnonzero((np.diff(offsets) > 0) & (count < SHINGLE + WINDOW - 1))
    at = np.concatenate([chosen, first[short]])
    words = np.concatenate([np.full(len(chosen), SHINGLE), count[short]])
    doc = np.concatenate([of[chosen], short])
    by = np.argsort(doc, kind="stable")
    at, words, doc = at[by], words[by], doc[by]
    lead = np.flatnonzero(np.append(True, doc[1:] != doc[:-1])) if len(doc) else doc
    index = np.arange(len(doc)) - np.repeat(lead, np.diff(np.append(lead, len(doc))))
    hashes = mixed((sums[at + words] - sums[at]) * down[at])
    return Layout(doc, index, hashes.view(np.int64), at - first[doc], words)


def _keys() -> list[Column]:
    return [F.col("doc_id").cast("long").alias("_doc"), F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("_crc")]


def _joined(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """Join on KEY, a null doc_id being equal to itself."""
    right = right.select(*[F.col(c).alias(f"r{c}") if c in KEY else F.col(c) for c in right.columns])
    same = F.col("_crc").eqNullSafe(F.col("r_crc")) & F.col("_doc").eqNullSafe(F.col("r_doc"))
    return left.join(right, same, how).drop("r_crc", "r_doc")


def fingerprint_index(docs: DataFrame) -> DataFrame:
    """``_doc, _crc, h, word``: hash and first word of each fingerprint of SHINGLE words, written once."""

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base = 0
            for data, offsets in _pieces(batch.column(2)):
                found = layout(data, offsets)
                whole = found.words == SHINGLE
                take = pa.array(found.doc[whole] + base)
                base += len(offsets) - 1
                columns = [batch.column(c).take(take) for c in range(2)]
                columns += [pa.array(found.hash[whole]), pa.array(found.word[whole].astype(np.int32))]
                yield pa.RecordBatch.from_arrays(columns, [*KEY, "h", "word"])

    return materialised(bounded_batches(docs).select(*_keys(), "text").mapInArrow(index, f"{NAMES}, h long, word int"))


def runs(index: DataFrame) -> DataFrame:
    """``_doc, _crc, a, n, f_doc, f_crc, fa``: words ``a .. a+n-1`` are also, earlier, the words ``fa ..`` of another place.

    Earlier is the last place before in the same document, else the first one of all by
    doc_id, then checksum, then position. Hashes alone are counted first; places are
    compared for repeated ones only. A hash of a third of all rows is counted before it
    moves, and its rows are joined to one row.
    """
    place = F.struct(*KEY, "word")
    repeated = materialised(index.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h"))
    rows = materialised(index.join(repeated, "h", "left_semi"))
    groups = rows.groupBy("h").agg(F.min(place).alias("lo"))
    rows = rows.join(groups, "h").repartition(*KEY).distinct()
    before = F.lag("word").over(W.partitionBy(*KEY, "h").orderBy("word"))
    rows = rows.withColumn("_before", before).where(F.col("_before").isNotNull() | (place != F.col("lo")))
    own = F.col("_before").isNotNull()
    source = [F.when(own, F.col(k)).otherwise(F.col(f"lo.{k}")).alias(f) for k, f in zip(KEY, ("f_doc", "f_crc"))]
    rows = rows.select(*KEY, "word", *source, (F.coalesce("_before", "lo.word") - F.col("word")).alias("d"))
    order = W.partitionBy(*KEY).orderBy("word")  # a document's own fingerprints
    origin = F.struct("f_doc", "f_crc", "d")
    goes_on = F.lag(origin).over(order).eqNullSafe(origin) & (F.col("word") - F.lag("word").over(order) <= SHINGLE)
    rows = rows.withColumn("_new", (~F.coalesce(goes_on, F.lit(False))).cast("int"))
    rows = rows.withColumn("_run", F.sum("_new").over(order))
    found = rows.groupBy(*KEY, "_run", "f_doc", "f_crc", "d").agg(F.min("word").alias("a"), (F.max("word") - F.min("word") + SHINGLE).alias("n"))
    return materialised(found.select(*KEY, "a", "n", "f_doc", "f_crc", (F.col("a") + F.col("d")).alias("fa")))


SLICE = "a int, n int, f_doc long, f_crc long, fa int, at int, before binary, text binary, after binary"


def slices(docs: DataFrame, found: DataFrame) -> DataFrame:
    """Texts of the runs ``found`` and, each once and with a null ``fa``, of their sources, with WINDOW words on both sides.

    ``at`` is the byte at which ``text`` starts.
    """
    nothing = [F.lit(None).cast(t).alias(c) for c, t in (("f_doc", "long"), ("f_crc", "long"), ("fa", "int"))]
    sources = found.select(F.col("f_doc").alias("_doc"), F.col("f_crc").alias("_crc"), F.col("fa").alias("a"), "n").distinct()
    asked = ["a", "n", "f_doc", "f_crc", "fa"]
    wanted = found.select(*KEY, *asked).unionByName(sources.select("*", *nothing))
    per = wanted.groupBy(*KEY).agg(F.collect_list(F.struct(*asked)).alias("runs"))  # of one document
    joined = _joined(docs.select(*_keys(), "text"), per).select(*KEY, "text", "runs")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        longs, ints, texts = [pa.int64()] * 2, [pa.int32()] * 2, [pa.binary()] * 3
        kinds = [*longs, *ints, *longs, *ints, *texts]
        names = [*KEY, *asked, "at", "before", "text", "after"]
        for batch in batches:
            rows: list[tuple] = []
            for doc, crc, text, runs_ in zip(*(c.to_pylist() for c in batch.columns)):
                data = text.encode()
                edge = np.append(word_places(np.frombuffer(data, np.uint8), np.array([0, len(data)]))[0], len(data))
                for r in runs_:
                    a, b = r["a"], r["a"] + r["n"]
                    low, high = edge[max(a - WINDOW, 0)], edge[min(b + WINDOW, len(edge) - 1)]
                    rows.append((doc, crc, *(r[c] for c in asked), int(edge[a]), data[low : edge[a]], data[edge[a] : edge[b]], data[edge[b] : high]))
                if len(rows) > 1000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)

    return materialised(joined.mapInArrow(cut, f"{NAMES}, {SLICE}"))


def pieces(text: str) -> list[str]:
    """Words of a text, white space after each included, and what is before the first one."""
    data = text.encode()
    starts = word_places(np.frombuffer(data, np.uint8), np.array([0, len(data)]))[0].tolist()
    edges = sorted({0, *starts, len(data)})
    return [data[a:b].decode() for a, b in zip(edges, edges[1:])]


def same_text[T: (str, bytes)](x: T, y: T) -> bool:
    """Equal apart from white space."""
    return x == y or x.split() == y.split()


def same_stretches(x: bytes, y: bytes) -> list[tuple[int, int, int, int]]:
    """``b0, b1, w0, w1``: bytes of ``x``, and words, of the stretches in which words of one place are equal."""
    if same_text(x, y):
        return [(0, len(x), 0, len(x.split()))]
    edge = np.append(word_places(np.frombuffer(x, np.uint8), np.array([0, len(x)]))[0], len(x)).tolist()
    found, since = [], None
    for i, (a, b) in enumerate([*zip(x.split(), y.split()), (b"", None)]):
        if a == b and since is None:
            since = i
        elif a != b and since is not None:
            found.append((edge[since], edge[i], since, i))
            since = None
    return found


def alike(x: list, y: list) -> int:
    """How many words two lists share from their start."""
    n = 0
    for a, b in zip(x, y):
        if a != b:
            break
        n += 1
    return n


def shared_end[T: (str, bytes)](x: T, y: T) -> tuple[T, int]:
    """The end of ``x`` that has the words ``y`` ends with too, and their number."""
    n = alike(x.split()[::-1], y.split()[::-1])
    if not n:
        return x[:0], 0
    parts = x.rsplit(None, n)
    return x[len(parts[0]) :].lstrip() if len(parts) > n else x, n


def shared_start[T: (str, bytes)](x: T, y: T) -> tuple[T, int]:
    """The start of ``x`` that has the words ``y`` starts with too, and their number."""
    n = alike(x.split(), y.split())
    if not n:
        return x[:0], 0
    parts = x.split(None, n)
    return x[: len(x) - len(parts[n])] if len(parts) > n else x, n


def repeats(texts: DataFrame) -> DataFrame:
    """``_doc, _crc, b0, b1, w0, w1``: bytes and words of each stretch of a run that equals its source, with its extension."""
    own = texts.where("fa is not null").alias("x")
    source = texts.where("fa is null").select(*KEY, "a", "n", *[F.col(c).alias(f"f_{c}") for c in ("before", "text", "after")]).alias("y")
    same = F.col("x.f_crc").eqNullSafe(F.col("y._crc")) & F.col("x.f_doc").eqNullSafe(F.col("y._doc"))
    both = own.join(source, same & (F.col("x.fa") == F.col("y.a")) & (F.col("x.n") == F.col("y.n")))
    both = both.select("x._doc", "x._crc", "at", F.col("x.a").alias("word"), "before", "text", "after", "f_before", "f_text", "f_after")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, crc, at, word, before, text, after, fb, ft, fa in zip(*(c.to_pylist() for c in batch.columns)):
                for b0, b1, w0, w1 in same_stretches(text, ft):
                    low, more = shared_end(before, fb) if b0 == 0 else (b"", 0)
                    high, further = shared_start(after, fa) if b1 == len(text) else (b"", 0)
                    rows.append((doc, crc, at + b0 - len(low), at + b1 + len(high), word + w0 - more, word + w1 + further))
            columns = list(zip(*rows)) if rows else [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], [*KEY, "b0", "b1", "w0", "w1"])

    return both.mapInArrow(compare, f"{NAMES}, b0 long, b1 long, w0 long, w1 long")


def removed_ranges(found: DataFrame) -> DataFrame:
    """``_doc, _crc, _cut``: byte ranges to remove of each document, in order and apart.

    Runs that touch or overlap form one stretch; it counts if it has LEAST_WORDS words.
    """
    counted = found.where(F.col("w1") - F.col("w0") >= LEAST_MATCH)
    per = counted.groupBy(*KEY).agg(F.sort_array(F.collect_set(F.struct("b0", "b1", "w0", "w1"))).alias("r"))  # of one document

    def step(done: Column, r: Column) -> Column:
        last = F.element_at(done, -1)
        wider = F.struct(last["b0"].alias("b0"), F.greatest(last["b1"], r["b1"]).alias("b1"), last["w0"].alias("w0"), F.greatest(last["w1"], r["w1"]).alias("w1"))
        met = (F.size(done) > 0) & (r["b0"] <= F.try_element_at(done, F.lit(-1))["b1"])
        return F.when(met, F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), F.array(wider))).otherwise(F.concat(done, F.array(r)))

    empty = F.array().cast("array<struct<b0:bigint,b1:bigint,w0:bigint,w1:bigint>>")
    merged = F.aggregate("r", empty, step)
    cut = F.filter(merged, lambda s: s["w1"] - s["w0"] >= LEAST_WORDS)
    return per.select(*KEY, cut.alias("_cut")).where(F.size("_cut") > 0)


def _without(text: Column, ranges: Column) -> Column:
    """``text`` without the byte ranges."""
    data = text.cast("binary")
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("kept"))
    part = lambda a, b: F.substring(data, (a + 1).cast("int"), (b - a).cast("int")).cast("string")
    step = lambda s, r: F.struct(r["b1"].alias("at"), F.concat(s["kept"], F.array(part(s["at"], r["b0"]))).alias("kept"))
    return F.aggregate(ranges, start, step, lambda s: F.concat(F.array_join(s["kept"], ""), part(s["at"], F.octet_length(text).cast("long"))))


def deduplicated(docs: DataFrame) -> DataFrame:
    """``docs`` with repeated passages taken out of ``text``, and ``n_removed`` (passages) and ``share_left`` (of the bytes).

    Every row stays, its other columns as they are. A null text stays null, an empty
    one empty, with nothing removed. Rows equal in doc_id and text are one document:
    they keep a passage together or lose it together. A passage repeated inside one
    document stays where it is first. Input columns with the names of the two added
    ones are replaced.
    """
    bare = docs.select("doc_id", "text")
    found = runs(fingerprint_index(bare))
    ranges = materialised(removed_ranges(repeats(slices(bare, found))))
    columns = [c for c in docs.columns if c not in ("n_removed", "share_left")]
    whole = docs.select(F.struct(*columns).alias("_row"), *_keys())
    keyed = _joined(whole, ranges, "left")
    text = F.col("_row.text")
    left = keyed.select("_row", F.when(F.col("_cut").isNull(), text).otherwise(_without(text, F.col("_cut"))).alias("_text"), F.when(F.col("_cut").isNull(), 0).otherwise(F.size("_cut")).alias("n_removed"))
    share = F.when(F.col("n_removed") == 0, 1.0).otherwise(F.octet_length("_text") / F.octet_length(text))
    shown = [F.col("_text").alias(c) if c == "text" else F.col("_row")[c].alias(c) for c in columns]
    return left.select(*shown, "n_removed", share.alias("share_left"))


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` without repeated passages, and without documents of which no word remains.

    A document with words of its own left stays, however few, as later holders of
    its passages may have lost them to it: every passage is left in some document.
    """
    done = deduplicated(docs)
    return done.where((F.col("n_removed") == 0) | (F.translate("text", SPACES, "") != "")).select(*docs.columns)
