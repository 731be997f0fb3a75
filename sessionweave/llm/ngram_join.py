"""Exact n-gram Jaccard join as a blocked sparse product of documents by n-grams.

Documents with equal shingle sets form one class, and classes are joined. Two sets
that reach the similarity share an n-gram among the first ``n - ceil(0.8 n) + 1`` of
each in any one global order, so only those columns of the incidence matrix are
grouped; n-grams found often (passages that many documents hold) come last in the
order. First the least document of every column of more than FEW documents is
multiplied with the column's other documents, in blocks. Then documents of different
components that share a column of few documents are met; the number of columns
they share bounds their overlap, and pairs that cannot reach the similarity are
dropped. In longer columns that still hold several components, documents outside the
largest one are met with all, tile by tile. Every pair is held against a bound from
bit sketches of both sets before whole sets move: a bit that only one of them has
stands for an n-gram that the other lacks. A tile of whole sets accumulates
overlap counts over blocks of columns and drops pairs that cannot reach the
bound their sizes give; only links leave it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionweave.llm.common import bounded_batches, materialised, most_frequent
from sessionweave.llm.components import components
from sessionweave.llm.fingerprints import K, shingle_sets

#: Similarity in percent.
PERCENT = 80
#: n-grams counted as frequent: at most so many, the most frequent ones. They only change the order of columns.
FREQUENT = 1 << 17
LEAST_FREQUENT = 12
#: A task counts n-grams in blocks of this many and reports those that a block holds LOCAL times.
COUNTED, LOCAL, REPORTED = 2_000_000, 4, 20_000
#: Documents and shingles of one side of a tile.
TILE_ROWS, TILE_SHINGLES = 128, 400_000
#: Columns of more than FEW documents start with a star; of those of up to SOME the rest is compared by pairs, of others by tiles.
FEW, SOME = 8, 32
#: Most nodes (8 bytes each) that are broadcast to pick their texts.
LOOKED_UP = 500_000
#: Columns of a tile multiplied at a time.
COLUMNS = 4096
#: Bits of a sketch for each n-gram of a set, at least; at most twice as many.
BITS = 4
#: Stands for a null doc_id, which counts as one document.
NO_ID = -(1 << 63)

LINKS = "u long, v long"


def node_of(doc_id: Column) -> Column:
    return F.coalesce(doc_id.cast("long"), F.lit(NO_ID))


def bound_length(n: int, percent: int = PERCENT) -> int:
    """Columns of a set of ``n`` that every partner shares one of."""
    return n - -(-percent * n // 100) + 1


def sketch(s: np.ndarray) -> bytes:
    """A bit for the last digits of every n-gram of a set; as many bits as a power of two, 64 at least."""
    size = 64
    while size < BITS * len(s):
        size *= 2
    bits = np.zeros(size, bool)
    bits[s & (size - 1)] = True
    return np.packbits(bits, bitorder="little").tobytes()


def _folded(words: np.ndarray, width: int) -> np.ndarray:
    """The sketch (along the last axis) in fewer 64-bit words, as a set's sketch of that size would be."""
    while words.shape[-1] > width:
        half = words.shape[-1] // 2
        words = words[..., :half] | words[..., half:]
    return words


def possible(n: int, bits: np.ndarray, others: np.ndarray, sketches: np.ndarray) -> np.ndarray:
    """Which sets of sizes ``others`` and ``sketches`` (a row each) may be linked with that of size ``n`` and sketch ``bits``.

    A bit that only one of two sketches has stands for at least one n-gram that the
    other set lacks, so the overlap is at most the size less those bits, on both sides.
    """
    width = min(len(bits), sketches.shape[1])
    x, y = _folded(bits, width), _folded(sketches, width)
    only_x = np.bitwise_count(x & ~y).sum(axis=1, dtype=np.int64)
    only_y = np.bitwise_count(y & ~x).sum(axis=1, dtype=np.int64)
    most = np.minimum(n - only_x, others - only_y)
    return (100 + PERCENT) * most >= PERCENT * (n + others)


def profiles(docs: DataFrame, k: int = K) -> tuple[DataFrame, DataFrame]:
    """Per document ``node, n, d1, d2, bits`` (set size, digest, sketch), and ``h, c`` of n-grams that are frequent somewhere."""

    def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def frequent() -> tuple[np.ndarray, np.ndarray]:
            values, counts = np.unique(np.concatenate(held), return_counts=True)
            top = np.flatnonzero(counts >= LOCAL)
            top = top[np.argsort(-counts[top], kind="stable")[:REPORTED]]
            return values[top], counts[top]

        def rows(kind, node, n, d1, d2, bits=None):
            columns = [pa.array(c, pa.int64()) for c in (np.full(len(node), kind), node, n, d1, d2)]
            columns.append(pa.array(bits, pa.binary()) if bits else pa.nulls(len(node), pa.binary()))
            return pa.RecordBatch.from_arrays(columns, ["kind", "node", "n", "d1", "d2", "bits"])

        for batch in batches:
            n, digests, bits = [], [], []
            for s in shingle_sets(batch.column(1), k):
                n.append(len(s))
                bits.append(sketch(s))
                digests.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                held.append(s)
                size += len(s)
                if size > COUNTED:
                    h, c = frequent()
                    yield rows(1, h, c, h, h)
                    held, size = [], 0
            d = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
            yield rows(0, batch.column(0).to_numpy(zero_copy_only=False), np.array(n, np.int64), d[:, 0], d[:, 1], bits)
        if size:
            h, c = frequent()
            yield rows(1, h, c, h, h)

    keyed = bounded_batches(docs).select(node_of(F.col("doc_id")).alias("node"), "text")
    both = materialised(keyed.mapInArrow(profile, "kind long, node long, n long, d1 long, d2 long, bits binary"))
    counted = both.where("kind = 1").groupBy(F.col("node").alias("h")).agg(F.sum("n").alias("c"))
    return both.where("kind = 0").drop("kind"), counted


def frequent_order(counted: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Sorted frequent n-grams and the rank of each by count; FREQUENT at most."""
    top = most_frequent(counted.where(F.col("c") >= LEAST_FREQUENT), "c", FREQUENT).toArrow()
    h, c = (top[x].to_numpy().astype(np.int64) for x in ("h", "c"))
    order = np.lexsort((h, c))
    rank = np.empty(len(h), np.int64)
    rank[order] = np.arange(len(h))
    by = np.argsort(h)
    return h[by], rank[by]


def first_columns(s: np.ndarray, order: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The n-grams of a set of which every partner shares one: frequent ones come last, else by value."""
    most = bound_length(len(s))
    known, rank = order
    if not len(known):
        return s[:most]
    at = np.minimum(np.searchsorted(known, s), len(known) - 1)
    often = known[at] == s
    rare = s[~often]
    if len(rare) >= most:
        return rare[:most]
    common = at[often]
    return np.concatenate([rare, known[common[np.argsort(rank[common])[: most - len(rare)]]]])


def columns_of(docs: DataFrame, order: tuple[np.ndarray, np.ndarray], k: int = K) -> DataFrame:
    """``h, node``: for each document the n-grams of which a partner shares one."""
    shared = docs.sparkSession.sparkContext.broadcast(order)

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, nodes = [], []
            for node, s in zip(batch.column(0).to_numpy(zero_copy_only=False), shingle_sets(batch.column(1), k)):
                if not len(s):
                    continue
                found.append(first_columns(s, shared.value))
                nodes.append(np.full(len(found[-1]), node, np.int64))
            if found:
                columns = [pa.array(np.concatenate(x)) for x in (found, nodes)]
                yield pa.RecordBatch.from_arrays(columns, ["h", "node"])

    keyed = docs.select(node_of(F.col("doc_id")).alias("node"), "text")
    return keyed.mapInArrow(first, "h long, node long")


def _looked_up(rows: DataFrame) -> DataFrame:
    """``rows`` written; broadcast up to LOOKED_UP of them, so that what they are joined to need not move."""
    rows = materialised(rows)
    return F.broadcast(rows) if rows.count() <= LOOKED_UP else rows


def shingle_table(docs: DataFrame, wanted: DataFrame, k: int = K) -> DataFrame:
    """``node, set`` of the documents whose node is in ``wanted``; one row for each of a node's different texts."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = list(shingle_sets(batch.column(1), k))
            offsets = np.concatenate([[0], np.cumsum([len(s) for s in found])]).astype(np.int32)
            values = np.concatenate(found) if found else np.zeros(0, np.int64)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], ["node", "set"])

    keyed = docs.select(node_of(F.col("doc_id")).alias("node"), "text").join(_looked_up(wanted.distinct()), "node", "left_semi")
    return keyed.mapInArrow(sets, "node long, set array<long>")


def overlaps(a: list[np.ndarray], b: list[np.ndarray], percent: int = PERCENT) -> np.ndarray:
    """Overlap counts of sorted sets ``a`` by ``b``: a product of incidence matrices over blocks of columns.

    Pairs that the counts so far and the columns to come cannot lift to the bound
    ``percent / (100 + percent) * (|a| + |b|)`` are dropped (count 0).
    """
    na, nb = np.array([len(s) for s in a]), np.array([len(s) for s in b])
    universe = np.unique(np.concatenate(a))
    at = [np.searchsorted(universe, s) for s in a]
    values = np.concatenate(b)
    rows = np.repeat(np.arange(len(b)), nb)
    place = np.minimum(np.searchsorted(universe, values), len(universe) - 1)
    same = universe[place] == values
    rows, place = rows[same], place[same]
    if len(a) == 1:
        return np.bincount(rows, minlength=len(b))[None, :]
    least = percent * (na[:, None] + nb[None, :]) / (100 + percent)
    alive = 100 * np.minimum(na[:, None], nb[None, :]) >= percent * np.maximum(na[:, None], nb[None, :])
    counts = np.zeros((len(a), len(b)), np.float32)
    by = np.argsort(place, kind="stable")
    rows, place = rows[by], place[by]
    left = np.bincount(rows, minlength=len(b))
    for start in range(0, len(universe), COLUMNS):
        if not alive.any():
            break
        width = min(COLUMNS, len(universe) - start)
        x = np.zeros((len(a), width), np.float32)
        for i, p in enumerate(at):
            x[i, p[np.searchsorted(p, start) : np.searchsorted(p, start + width)] - start] = 1
        lo, hi = np.searchsorted(place, [start, start + width])
        y = np.zeros((len(b), width), np.float32)
        y[rows[lo:hi], place[lo:hi] - start] = 1
        counts += x @ y.T
        left = left - np.bincount(rows[lo:hi], minlength=len(b))
        alive &= counts + left[None, :] >= least - 1e-3
    return np.where(alive, counts, 0).astype(np.int64)


def _sets(table: pa.Table) -> list[np.ndarray]:
    column = table["set"].combine_chunks()
    column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
    offsets, values = column.offsets.to_numpy(), column.values.to_numpy()
    return [values[a:b] for a, b in zip(offsets[:-1], offsets[1:])]


def _words(bits: pa.ChunkedArray) -> list[np.ndarray]:
    return [np.frombuffer(b, np.uint64) for b in bits.to_pylist()]


def _tile_pairs(table: pa.Table) -> pa.Table:
    """Pairs of side 0 and side 1 whose sketches do not rule them out; rows of one label are not met."""
    side, node, label, n = (table[c].to_numpy() for c in ("side", "node", "label", "n"))
    words = _words(table["bits"])
    left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    width = np.array([len(words[j]) for j in right], np.int64)
    u, v = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for w in np.unique(width):
        some = right[width == w]
        sketches = np.stack([words[j] for j in some])
        for i in left:
            met = np.flatnonzero((100 * np.minimum(n[i], n[some]) >= PERCENT * np.maximum(n[i], n[some])) & (label[some] != label[i]))
            if len(met):
                found = some[met[possible(n[i], words[i], n[some[met]], sketches[met])]]
                u.append(np.full(len(found), i))
                v.append(found)
    u, v = np.concatenate(u), np.concatenate(v)
    return pa.table({"u": pa.array(node[u], pa.int64()), "v": pa.array(node[v], pa.int64()), "nv": pa.array(n[v], pa.int64())})


def _tile_links(table: pa.Table) -> pa.Table:
    """Links between side 0 and side 1 of one tile; rows of one label are not compared."""
    side, node, label = (table[c].to_numpy() for c in ("side", "node", "label"))
    sets = _sets(table)
    left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    u, v = np.zeros(0, np.int64), np.zeros(0, np.int64)
    if len(left) and len(right):
        counts = overlaps([sets[i] for i in left], [sets[i] for i in right])
        na, nb = (np.array([len(sets[i]) for i in x]) for x in (left, right))
        union = na[:, None] + nb[None, :] - counts
        linked = (100 * counts >= PERCENT * union) & (label[left][:, None] != label[right][None, :])
        i, j = np.nonzero(linked)
        u, v = node[left][i], node[right][j]
    return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})


def _tiles(rows: Column, shingles: Column) -> Column:
    """Tiles that a side of so many rows and shingles is dealt to."""
    return F.greatest(F.lit(1), F.ceil(rows / TILE_ROWS), F.ceil(shingles / TILE_SHINGLES)).cast("int")


def _possible(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """The pairs ``u, v, nv`` that their sketches ``node, n, bits`` do not rule out."""

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = _words(batch["bu"]), _words(batch["bv"])
            na, nb = batch["nu"].to_numpy(), batch["n"].to_numpy()
            stay = [bool(possible(na[i], a[i], nb[i : i + 1], b[i][None, :])[0]) for i in range(len(a))]
            yield batch.select(["u", "v", "nv"]).filter(pa.array(stay, pa.bool_()))

    ends = pairs.select(F.col("u").alias("node")).unionByName(pairs.select(F.col("v").alias("node")))
    some = materialised(sketches.join(_looked_up(ends.distinct()), "node", "left_semi"))
    left = some.select(F.col("node").alias("u"), F.col("n").alias("nu"), F.col("bits").alias("bu"))
    right = some.select(F.col("node").alias("v"), "n", F.col("bits").alias("bv"))
    return materialised(pairs.join(left, "u").join(right, "v").mapInArrow(kept, "u long, v long, nv long").distinct())


def _linked(pairs: DataFrame, docs: DataFrame, k: int) -> DataFrame:
    """Links among the pairs ``u, v, nv``: every ``u`` is multiplied with its partners, block by block."""
    if pairs.isEmpty():
        return pairs.select("u", "v")
    per = pairs.groupBy("u").agg(_tiles(F.count(F.lit(1)), F.sum("nv")).alias("t"))
    right = pairs.join(per, "u").select("u", F.pmod(F.xxhash64("v"), "t").cast("int").alias("j"), F.lit(1).alias("side"), F.col("v").alias("node"))
    left = per.select("u", F.explode(F.sequence(F.lit(0), F.col("t") - 1)).alias("j"), F.lit(0).alias("side"), F.col("u").alias("node"))
    tiles = _looked_up(right.unionByName(left).select(F.col("u").alias("g"), "j", "side", "node", F.col("node").alias("label")))
    full = shingle_table(docs, tiles.select("node"), k).join(tiles, "node").select("g", "j", "side", "node", "label", "set")
    return materialised(full.groupBy("g", "j").applyInArrow(_tile_links, LINKS))


def _grown(roots: DataFrame, links: DataFrame) -> DataFrame:
    """``roots`` after more links."""
    if links.isEmpty():
        return roots
    return materialised(components(links.unionByName(roots.select(F.col("node").alias("u"), F.col("component").alias("v")))))


def _labelled(inside: DataFrame, pivots: DataFrame, roots: DataFrame) -> DataFrame:
    rows = inside.join(pivots.select("h", "m"), "h").join(roots, "node", "left")
    return rows.select("h", "m", "node", "n", F.coalesce("component", "node").alias("label"))


def _pairs(inside: DataFrame, pivots: DataFrame, roots: DataFrame) -> DataFrame:
    """Pairs ``u, v, nv`` of different components from columns of at most SOME documents that their counts do not rule out.

    A column gives each of its documents fewer than SOME partners, so rows stay in
    proportion. ``a`` counts the columns a pair shares. Of the one whose columns end
    first in the order, all are known, so at most ``ceil(0.8 n) - 1`` more can be shared,
    n being its size: a pair whose ``a`` cannot reach the bound is dropped. (A pair
    that also shares a larger column is found there.)
    """
    rows = materialised(_labelled(inside, pivots.where(F.col("m") <= SOME), roots))
    x, y = rows.alias("x"), rows.alias("y")
    near = 100 * F.least("x.n", "y.n") >= PERCENT * F.greatest("x.n", "y.n")
    met = x.join(y, (F.col("x.h") == F.col("y.h")) & (F.col("x.node") < F.col("y.node")) & (F.col("x.label") != F.col("y.label")) & near)
    met = met.groupBy(F.col("x.node").alias("u"), F.col("y.node").alias("v"), F.col("x.n").alias("nu"), F.col("y.n").alias("nv"))
    met = met.agg(F.count(F.lit(1)).alias("a"))
    more = F.ceil(F.greatest("nu", "nv") * PERCENT / 100) - 1
    return met.where((100 + PERCENT) * (F.col("a") + more) >= PERCENT * (F.col("nu") + F.col("nv"))).groupBy("u", "v").agg(F.max("nv").alias("nv"))


def linked_classes(docs: DataFrame, k: int = K) -> tuple[DataFrame, DataFrame]:
    """``sizes`` (``node, n`` of every row) and ``roots`` (``node, component`` of every linked node)."""
    sizes, counted = profiles(docs, k)
    classes = sizes.where("n > 0").groupBy("d1", "d2", "n").agg(F.min("node").alias("rep"))
    members = materialised(sizes.where("n > 0").join(classes, ["d1", "d2", "n"]).select("node", "n", "rep").distinct())
    order = frequent_order(counted)
    column_rows = columns_of(docs, order, k)

    many = materialised(column_rows.groupBy("h").count().where("count > 1").select("h"))
    reps = members.select("node", "rep", "n")
    inside = column_rows.join(many, "h", "left_semi").join(reps, "node").select("h", F.col("rep").alias("node"), "n").distinct()
    inside = materialised(inside)
    pivots = inside.groupBy("h").agg(F.min(F.struct("node", "n")).alias("p"), F.count(F.lit(1)).alias("m")).where("m > 1")
    pivots = materialised(pivots.select("h", F.col("p.node").alias("pivot"), F.col("p.n").alias("pn"), "m"))

    sketches = sizes.where("n > 0").select("node", "n", "bits")
    near = 100 * F.least("n", "pn") >= PERCENT * F.greatest("n", "pn")
    stars = inside.join(pivots.where(F.col("m") > FEW), "h").where((F.col("node") != F.col("pivot")) & near)
    stars = materialised(stars.select(F.col("pivot").alias("u"), F.col("node").alias("v"), F.col("n").alias("nv")).distinct())
    links = _linked(_possible(stars, sketches), docs, k)

    same_node = members.where("node <> rep").select(F.col("node").alias("u"), F.col("rep").alias("v"))
    roots = materialised(components(links.unionByName(same_node)))
    pairs = _possible(materialised(_pairs(inside, pivots, roots)), sketches)
    rest = _unresolved(inside, pivots.where(F.col("m") > SOME), roots)
    if not rest.isEmpty():
        some = sketches.join(_looked_up(rest.select("node").distinct()), "node", "left_semi")
        full = rest.drop("n").join(some, "node")
        met = full.groupBy("g", "i", "j").applyInArrow(_tile_pairs, "u long, v long, nv long")
        pairs = pairs.unionByName(met).groupBy("u", "v").agg(F.max("nv").alias("nv"))
    roots = _grown(roots, _linked(materialised(pairs), docs, k))
    return sizes.select("node", "n"), roots


def _unresolved(inside: DataFrame, pivots: DataFrame, roots: DataFrame) -> DataFrame:
    """Tiles ``g, i, j, side, node, label, n`` of columns that more than one component holds.

    Side 0 has the nodes outside the column's largest component, side 1 all.
    Columns with the same nodes are taken once.
    """
    rows = _labelled(inside, pivots, roots)
    labels = rows.groupBy("h", "label").agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("s"), F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("x"))
    whole = labels.groupBy("h").agg(
        F.count(F.lit(1)).alias("labels"), F.sum("c").alias("c"), F.sum("s").alias("s"), F.sum("x").alias("x"), F.max(F.struct("c", "s", "label")).alias("top")
    ).where("labels > 1")
    once = whole.groupBy("c", "s", "x").agg(F.min("h").alias("h"), F.first("top").alias("top"))
    once = once.select("h", F.col("top.label").alias("top"), _tiles(F.col("c"), F.col("s")).alias("kb"), _tiles(F.col("c") - F.col("top.c"), F.col("s") - F.col("top.s")).alias("ka"))
    rows = materialised(rows.join(once, "h"))
    slot = lambda k: F.pmod(F.xxhash64("node"), k).cast("int")
    every = lambda k: F.explode(F.sequence(F.lit(0), F.col(k) - 1))
    left = rows.where("label <> top").select(F.col("h").alias("g"), slot("ka").alias("i"), every("kb").alias("j"), F.lit(0).alias("side"), "node", "label", "n")
    right = rows.select(F.col("h").alias("g"), every("ka").alias("i"), slot("kb").alias("j"), F.lit(1).alias("side"), "node", "label", "n")
    return materialised(left.unionByName(right))


def near_duplicates(docs: DataFrame, k: int = K) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row of ``docs`` (``doc_id, text``).

    Two documents are linked if 100 * common shingles >= 80 * all shingles of both;
    ``component_id`` is the least doc_id that links reach. Texts of fewer than ``k``
    words have one shingle, the whole; texts without words (null too) have none and no
    links. Rows that share a doc_id count as one document with several texts. An
    empty table gives an empty result; columns other than doc_id and text are ignored.
    """
    sizes, roots = linked_classes(docs, k)
    named = sizes.join(roots, "node", "left")
    chosen = F.when(F.col("n") > 0, F.coalesce("component", "node")).otherwise(F.col("node"))
    real = lambda c: F.when(c != NO_ID, c)
    return named.select(real(F.col("node")).alias("doc_id"), F.col("n").alias("n_shingles"), real(chosen).alias("component_id"))


def without_near_duplicates(docs: DataFrame, k: int = K) -> DataFrame:
    """One document of each group of linked ones, the one with the least doc_id; rows without words stay.

    Of rows that share a doc_id one stays as well (the least text).
    """
    found = near_duplicates(docs, k)
    gone = found.where("n_shingles > 0 and doc_id <> component_id or (doc_id is not null and component_id is null)")
    gone = materialised(gone.select(F.col("doc_id").alias("_doc")).distinct())
    kept = docs.join(gone, docs["doc_id"] == gone["_doc"], "left_anti")
    repeated = found.where("n_shingles > 0").groupBy("doc_id").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    repeated = materialised(repeated.select(F.col("doc_id").alias("_doc")))
    if repeated.isEmpty():
        return kept
    same = kept["doc_id"].eqNullSafe(repeated["_doc"])
    columns = docs.columns
    several = kept.join(repeated, same, "left_semi").groupBy("doc_id").agg(F.min(F.struct("text", *[c for c in columns if c not in ("doc_id", "text")])).alias("_r"))
    several = several.select(*[F.col("doc_id") if c == "doc_id" else F.col(f"_r.{c}").alias(c) for c in columns])
    return kept.join(repeated, same, "left_anti").unionByName(several)
