"""Benchmark decontamination by SimHash windows, multi-index Hamming search and exact verification.

Every benchmark item has a SimHash of its word shingles. In a document each window
of an item's size has one as well, from running sums of the shingles' bits. A
window without any shingle of the benchmark has similarity 0 and is passed over.
Fingerprints are cut into RADIUS + 1 blocks: two that differ in at most RADIUS bits
agree in a block, so lookups by block find all items within the radius. Candidates
are verified by the exact weighted similarity of shingles (least over greatest
multiplicity). The benchmark is small by nature; it is sent to the tasks in
blocks of bounded size, one pass over the documents for each.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionweave.llm.common import bounded_batches, materialised
from sessionweave.llm.fingerprints import K, PUNCTUATION, shingled, word_lists, word_pieces

SIMILARITY = 0.8
#: Bits of 64 within which fingerprints are searched. Sets of similarity 0.8 differ in about 10, with a deviation of 3.
RADIUS = 20
#: Most items and bytes of item text of one pass.
PASS_ITEMS, PASS_BYTES = 50_000, 32 << 20

HITS = "doc_id {kind}, item_id {item}, start long, words long, distance int, similarity double"


def simhash(shingles: np.ndarray) -> np.uint64:
    """Fingerprint of a multiset of shingle hashes."""
    return windows_simhash(shingles, len(shingles))[0]


def windows_simhash(shingles: np.ndarray, size: int) -> np.ndarray:
    """Fingerprint of each window of ``size`` shingles, by running sums of their bits."""
    bits = np.unpackbits(shingles.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
    sums = np.zeros((len(shingles) + 1, 64), np.int32)
    np.cumsum(bits, axis=0, out=sums[1:])
    ones = sums[size:] - sums[: len(sums) - size]
    return np.packbits(2 * ones > size, axis=1).view(">u8").ravel().astype(np.uint64)


def block_edges(radius: int = RADIUS) -> list[tuple[int, int]]:
    """Shift and width of RADIUS + 1 blocks that cover 64 bits."""
    edges = np.linspace(0, 64, radius + 2).astype(int)
    return [(int(a), int(b - a)) for a, b in zip(edges, edges[1:])]


@dataclass
class BlockIndex:
    """Fingerprints by the value of each of their blocks."""

    prints: np.ndarray
    radius: int = RADIUS
    tables: list = field(default_factory=list)

    def __post_init__(self):
        for shift, width in block_edges(self.radius):
            values = (self.prints >> np.uint64(shift)) & np.uint64((1 << width) - 1)
            order = np.argsort(values, kind="stable")
            self.tables.append((np.uint64(shift), np.uint64((1 << width) - 1), values[order], order))

    def within(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``query, item, distance`` of all pairs that differ in at most ``radius`` bits."""
        pairs = []
        for shift, mask, values, order in self.tables:
            wanted = (queries >> shift) & mask
            low, high = np.searchsorted(values, wanted), np.searchsorted(values, wanted, "right")
            count = high - low
            query = np.repeat(np.arange(len(queries)), count)
            step = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            pairs.append(query * len(self.prints) + order[np.repeat(low, count) + step])
        found = np.unique(np.concatenate(pairs))
        query, item = found // len(self.prints), found % len(self.prints)
        distance = np.bitwise_count(queries[query] ^ self.prints[item])
        near = distance <= self.radius
        return query[near], item[near], distance[near]


def weighted_similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Sum of least over sum of greatest multiplicities of two lists of shingles."""
    if not len(a) or not len(b):
        return 0.0
    values, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    x = np.bincount(place[: len(a)], minlength=len(values))
    y = np.bincount(place[len(a) :], minlength=len(values))
    return float(np.minimum(x, y).sum() / np.maximum(x, y).sum())


class Benchmark:
    """Items by shingle length and size, with their block indexes and the set of all their shingles."""

    def __init__(self, ids: list, texts: pa.Array, radius: int = RADIUS):
        self.groups: dict[int, dict[int, tuple[list, list, BlockIndex]]] = {}
        sized: dict[tuple[int, int], list] = {}
        for item, words in zip(ids, word_lists(texts, PUNCTUATION)):
            if len(words):
                k = min(K, len(words))
                shingles = shingled(words, k)
                sized.setdefault((k, len(shingles)), []).append((item, shingles))
        self.known: dict[int, np.ndarray] = {}
        for (k, size), items in sorted(sized.items()):
            prints = np.array([simhash(s) for _, s in items], np.uint64)
            self.groups.setdefault(k, {})[size] = ([i for i, _ in items], [s for _, s in items], BlockIndex(prints, radius))
        for k, groups in self.groups.items():
            self.known[k] = np.unique(np.concatenate([s for _, lists, _ in groups.values() for s in lists]))
        # One bit per possible 22-bit beginning of a shingle: most of a document's shingles need no search.
        self.maybe = {k: np.zeros(1 << 22, bool) for k in self.known}
        for k, values in self.known.items():
            self.maybe[k][values >> np.uint64(42)] = True

    def anchors(self, shingles: np.ndarray, k: int) -> np.ndarray:
        """Positions of shingles that some item has."""
        at = np.flatnonzero(self.maybe[k][shingles >> np.uint64(42)])
        known = self.known[k]
        place = np.minimum(np.searchsorted(known, shingles[at]), len(known) - 1)
        return at[known[place] == shingles[at]]

    def holding(self, words: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Which of several texts hold a shingle that some item has; text i has the words from ``first[i]`` on."""
        found = np.zeros(len(first) - 1, bool)
        for k in self.groups:
            at = self.anchors(shingled(words, k), k)
            text = np.searchsorted(first, at, "right") - 1
            found[text[at + k <= first[text + 1]]] = True
        return np.flatnonzero(found)

    def search(self, words: np.ndarray) -> list[tuple]:
        """``item, start, words, distance, similarity`` of the best window of each item that reaches SIMILARITY."""
        best: dict = {}
        for k, groups in self.groups.items():
            shingles = shingled(words, k)
            if not len(shingles):
                continue
            at = self.anchors(shingles, k)
            if not len(at):
                continue
            for size, (ids, lists, index) in groups.items():
                width = min(size, len(shingles))
                for low, high in _regions(at, width, len(shingles)):
                    prints = windows_simhash(shingles[low : high + width], width)
                    for q, i, distance in zip(*index.within(prints)):
                        start = low + int(q)
                        s = weighted_similarity(shingles[start : start + width], lists[i])
                        if s >= SIMILARITY and (ids[i] not in best or s > best[ids[i]][3]):
                            best[ids[i]] = (start, width + k - 1, int(distance), s)
        return [(item, *values) for item, values in best.items()]


def _regions(at: np.ndarray, width: int, n: int) -> list[tuple[int, int]]:
    """Ranges of window starts (first, last) whose windows hold one of the positions ``at``."""
    low, high = np.maximum(at - width + 1, 0), np.minimum(at, n - width)
    out: list[list[int]] = []
    for a, b in zip(low.tolist(), high.tolist()):
        if out and a <= out[-1][1] + 1:
            out[-1][1] = max(out[-1][1], b)
        elif a <= b:
            out.append([a, b])
    return [(a, b) for a, b in out]


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row for each document and benchmark item it holds: ``doc_id, item_id, start, words, distance, similarity``.

    ``start`` and ``words`` say where the most similar window lies, in words parted by
    white space and ASCII punctuation, A-Z as a-z. Items of fewer than five words are
    one shingle and match only whole. Null and empty texts hold nothing; rows that share
    a doc_id are searched each; an empty table on either side gives an empty result.
    """
    kinds = [t.schema[c].dataType.simpleString() for t, c in ((docs, "doc_id"), (benchmark, "item_id"))]
    items = materialised(benchmark.where("text is not null").select("item_id", "text"))
    size = items.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("b")).first()
    passes = max(1, -(-size["n"] // PASS_ITEMS), -(-size["b"] // PASS_BYTES))
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(passes))
    found = [_one_pass(docs, items.where(part == i), kinds) for i in range(passes)]
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return materialised(out)


def _one_pass(docs: DataFrame, items: DataFrame, kinds: list[str]) -> DataFrame:
    held = items.toArrow()  # PASS_ITEMS and PASS_BYTES bound it
    ids, texts = held["item_id"].to_pylist(), held["text"].combine_chunks()
    texts = texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts
    shared = docs.sparkSession.sparkContext.broadcast((ids, texts))
    item_type = held.schema.field("item_id").type

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Benchmark(*shared.value)
        for batch in batches:
            rows, before = [], 0
            for words, first in word_pieces(batch.column(1), PUNCTUATION):
                for i in known.holding(words, first).tolist():
                    doc = batch.column(0)[before + i].as_py()
                    rows += [(doc, *hit) for hit in known.search(words[first[i] : first[i + 1]])]
                before += len(first) - 1
            columns = list(zip(*rows)) if rows else [()] * 6
            types = [batch.column(0).type, item_type, pa.int64(), pa.int64(), pa.int32(), pa.float64()]
            names = ["doc_id", "item_id", "start", "words", "distance", "similarity"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    return bounded_batches(docs).select("doc_id", "text").mapInArrow(search, HITS.format(kind=kinds[0], item=kinds[1]))


def without_benchmark(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without documents that hold a benchmark item."""
    bad = materialised(contaminated(docs, benchmark).select(F.col("doc_id").alias("_doc")).distinct())
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["_doc"]), "left_anti")
