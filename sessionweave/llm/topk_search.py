"""Exact search for the vectors of greatest inner product, in three phases with one threshold.

A vector is cut into BLOCKS runs of components; a block gives each vector a partial
score, and partial scores add up. (1) Every block lists its best partial scores for
each query; the listed vectors are scored in full, and the least of the best of these
full scores is a cutoff that the answer cannot fall below. (2) The cutoff goes out with
the queries. A vector that reaches it reaches cutoff / BLOCKS in some block, so each block
collects all entries that do. (3) An entry whose known partial scores, with cutoff / BLOCKS for
the others, stay below the cutoff goes; the rest are scored in full.

Equal vectors are searched for once. Queries and candidates are packed into blocks of
rows, and a task holds one block of each at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sessionweave.llm.common import bounded_batches, materialised

#: Runs of components.
BLOCKS = 2
#: Vectors to a packed block of candidates, and of queries.
CANDIDATES = 4096
QUERIES = 1024
#: Blocks of candidates whose lists one task joins, and blocks of queries it holds lists of at a time.
STRIP = 8
HELD = 16
SCALE = 64
#: Integer components beyond this are held to it (2**53; a score beyond the range of long is held to that range).
LARGEST = 1 << 53
#: The least score there is rules nothing out.
NO_CUTOFF = -(1 << 63)


def whole_numbers(vector: Column, scale: int = SCALE) -> Column:
    """``floor(scale * x)`` of each component; null for a null vector and for one with a null or non-finite component."""
    fine = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    held = F.transform(vector, lambda x: F.greatest(F.least(F.floor(x.cast("double") * scale).cast("double"), F.lit(float(LARGEST))), F.lit(-float(LARGEST))).cast("long"))
    return F.when(vector.isNotNull() & fine, held)


def _best(rows: DataFrame, keys: list[str], order: list[Column], most: int) -> DataFrame:
    """The first ``most`` rows of each key; tasks drop later ones before the shuffle."""
    place = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("_place", F.row_number().over(place)).where(F.col("_place") <= most)


def packed(vectors: DataFrame, size: int) -> tuple[DataFrame, int]:
    """Rows ``class, vector`` in blocks ``part, block, classes, width, numbers`` of at most ``size``, and the number of parts.

    A shorter vector counts as continued by zeros.
    """
    parts = max(1, -(-vectors.count() // size))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, made, classes, rows = TaskContext.get().partitionId(), 0, [], []

        def out():
            width = max(map(len, rows))
            numbers = np.zeros((len(rows), width), np.int64)
            for i, row in enumerate(rows):
                numbers[i, : len(row)] = row
            columns = {"part": pa.array([part], pa.int32()), "block": [part << 32 | made], "classes": [np.array(classes, "<i8").tobytes()], "width": [width], "numbers": [numbers.tobytes()]}
            return pa.RecordBatch.from_pydict(columns)

        for batch in batches:
            for c, row in zip(batch.column(0).to_pylist(), batch.column(1)):
                classes.append(c)
                rows.append(row.values.to_numpy(zero_copy_only=False))
                if len(rows) == size:
                    yield out()
                    made, classes, rows = made + 1, [], []
        if rows:
            yield out()

    spread = bounded_batches(vectors).select("class", "vector").repartition(parts)
    return materialised(spread.mapInArrow(pack, "part int, block long, classes binary, width long, numbers binary")), parts


def _matrix(numbers: bytes, width: int, full: int) -> np.ndarray:
    """A packed block of rows, continued by zeros to ``full`` columns."""
    rows = np.frombuffer(numbers, np.int64).reshape(-1, width) if width else np.zeros((0, 0), np.int64)
    return np.pad(rows, ((0, 0), (0, full - rows.shape[1])))


def _bound(q: np.ndarray, x: np.ndarray) -> int:
    """No sum of products is larger, whatever the signs."""
    return int(np.abs(q).max(initial=0)) * int(np.abs(x).max(initial=0)) * max(1, q.shape[1])


def _slack(q: np.ndarray, x: np.ndarray) -> float:
    """What rounding can add to or take from a score of ``_scores``."""
    bound = _bound(q, x)
    return 0.0 if bound < 1 << 53 else float(bound) * q.shape[1] * 2.0**-50


def _scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products of all rows of two integer matrices: exact while float or double holds them, else within ``_slack``."""
    kind = np.float32 if _bound(q, x) < 1 << 24 else np.float64
    return q.astype(kind) @ x.T.astype(kind)


def _pair_scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner product of each row of ``q`` with the same row of ``x``."""
    if _bound(q, x) < 1 << 62:
        return (q * x).sum(1)
    return np.array([min(max(sum(int(a) * int(b) for a, b in zip(u, v)), -(1 << 63)), (1 << 63) - 1) for u, v in zip(q, x)], np.int64)


def _cuts(width: int) -> list[int]:
    return [width * b // BLOCKS for b in range(BLOCKS + 1)]


def _each_tile(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    width = max(row["q_width"], row["width"])
    q, x = _matrix(row["q_numbers"], row["q_width"], width), _matrix(row["numbers"], row["width"], width)
    return np.frombuffer(row["q_classes"], "<i8"), np.frombuffer(row["classes"], "<i8"), q, x


def _over_tiles(tiles: DataFrame, work, schema: str) -> DataFrame:
    """A record batch ``work(row)`` of each tile."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i] for c in batch.schema.names}
                yield work({c: v.values.to_numpy() if isinstance(v, pa.ListScalar) else v.as_py() for c, v in row.items()})

    return bounded_batches(tiles).mapInArrow(run, schema)


def _tiles(queries: DataFrame, query_parts: int, candidates: DataFrame, parts: int, strip: int = 1) -> DataFrame:
    """Each packed block of candidates beside each one of queries, which it meets by the number of its part.

    ``strip`` neighbouring blocks of candidates go to one task.
    """
    spread = candidates.withColumn("q_part", F.explode(F.sequence(F.lit(0), F.lit(query_parts - 1))))
    renamed = queries.withColumnsRenamed({c: f"q_{c}" for c in queries.columns})
    met = spread.join(renamed, "q_part").withColumn("strip", F.floor(F.col("part") / strip)).drop("part")
    return met.repartition(query_parts * -(-parts // strip), "q_block", "strip")


class _Lists:
    """The best partial scores so far of each query of one block, in one run of components."""

    def __init__(self, most: int):
        self.most, self.floor = most, None
        self.rows = self.scores = self.x = self.block = self.at = np.zeros(0, np.int64)

    def add(self, scores: np.ndarray, x_ids: np.ndarray, block: int) -> None:
        width = scores.shape[1]
        if self.floor is None:
            k = min(self.most, width)
            to = np.argpartition(-scores, k - 1, 1)[:, :k].ravel()
            rows = np.repeat(np.arange(len(scores)), k)
        else:
            rows, to = np.nonzero(scores > self.floor[:, None])
        new = (rows, scores[rows, to], x_ids[to], np.full(len(rows), block), rows * width + to)
        rows, found, x, blocks, at = (np.concatenate(p) for p in zip((self.rows, self.scores, self.x, self.block, self.at), new))
        order = np.lexsort((-found, rows))
        first = np.searchsorted(rows[order], np.arange(len(scores)))
        order = order[np.arange(len(order)) - first[rows[order]] < self.most]
        self.rows, self.scores, self.x, self.block, self.at = rows[order], found[order], x[order], blocks[order], at[order]
        full = np.bincount(self.rows, minlength=len(scores)) == self.most
        self.floor = np.full(len(scores), -np.inf)
        self.floor[full] = self.scores[np.searchsorted(self.rows, np.flatnonzero(full), "right") - 1]


def local_lists(tiles: DataFrame, most: int) -> DataFrame:
    """``q, x, run, partial, q_block, block, at``: of each strip the ``most`` best partial scores of each query in each run of components.

    ``at`` is the place of the pair in its tile.
    """
    names = ["q", "x", "run", "partial", "q_block", "block", "at"]

    def lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple] = {}

        def out():
            for q_block, (q_ids, runs) in held.items():
                for run, found in enumerate(runs):
                    n = len(found.rows)
                    columns = [q_ids[found.rows], found.x, np.full(n, run), found.scores.astype(np.float64), np.full(n, q_block), found.block, found.at.astype(np.int32)]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)

        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
                q_ids, x_ids, q, x = _each_tile(row)
                if row["q_block"] not in held and len(held) == HELD:
                    yield from out()
                    held.clear()
                _, runs = held.setdefault(row["q_block"], (q_ids, [_Lists(most) for _ in range(BLOCKS)]))
                cuts = _cuts(q.shape[1])
                for found, a, b in zip(runs, cuts, cuts[1:]):
                    found.add(_scores(q[:, a:b], x[:, a:b]), x_ids, row["block"])
        yield from out()

    return bounded_batches(tiles).mapInArrow(lists, "q long, x long, run long, partial double, q_block long, block long, at int")


def sufficient_entries(tiles: DataFrame) -> DataFrame:
    """``q_block, block, entries``: of each tile the pairs that no partial score rules out, given the queries' ``q_cutoffs``."""

    def work(row):
        q_ids, x_ids, q, x = _each_tile(row)
        cutoff = np.frombuffer(row["q_cutoffs"], "<i8")
        cutoff = np.where(cutoff == NO_CUTOFF, -np.inf, cutoff.astype(np.float64))
        # A little lower, so that rounding loses nothing.
        cutoff = cutoff - np.abs(cutoff) * 1e-6 - 1 - BLOCKS * _slack(q, x)
        share = cutoff / BLOCKS
        cuts = _cuts(q.shape[1])
        partial = [_scores(q[:, i:j], x[:, i:j]) for i, j in zip(cuts, cuts[1:])]
        listed = np.zeros((len(q_ids), len(x_ids)), bool)
        for scores in partial:
            listed |= scores >= share.astype(scores.dtype)[:, None]
        at, to = np.nonzero(listed)
        known = sum(np.maximum(scores[at, to].astype(np.float64), share[at]) for scores in partial)
        possible = known >= cutoff[at]
        at = (at[possible] * len(x_ids) + to[possible]).astype(np.int32)
        entries = pa.ListArray.from_arrays(pa.array([0, len(at)], pa.int32()), pa.array(at))
        return pa.RecordBatch.from_arrays([pa.array([row["q_block"]]), pa.array([row["block"]]), entries], ["q_block", "block", "entries"])

    return _over_tiles(tiles, work, "q_block long, block long, entries array<int>")


def resolved(entries: DataFrame, queries: DataFrame, candidates: DataFrame, tasks: int) -> DataFrame:
    """``q, x, score`` of the pairs in ``q_block, block, entries``: whole scores, worked out tile by tile.

    Where the queries have ``cutoffs``, pairs below them are left out.
    """
    renamed = queries.drop("part").withColumnsRenamed({c: f"q_{c}" for c in queries.columns})
    tiles = entries.where("size(entries) > 0").join(candidates.drop("part"), "block").join(renamed, "q_block").repartition(tasks, "q_block", "block")

    def work(row):
        q_ids, x_ids, q, x = _each_tile(row)
        at, to = np.divmod(row["entries"].astype(np.int64), len(x_ids))
        steps = range(0, len(at), 1 << 16)
        score = np.concatenate([_pair_scores(q[at[i : i + (1 << 16)]], x[to[i : i + (1 << 16)]]) for i in steps])
        if "q_cutoffs" in row:
            reached = score >= np.frombuffer(row["q_cutoffs"], "<i8")[at]
            at, to, score = at[reached], to[reached], score[reached]
        return pa.RecordBatch.from_arrays([pa.array(q_ids[at]), pa.array(x_ids[to]), pa.array(score)], ["q", "x", "score"])

    return _over_tiles(tiles, work, "q long, x long, score long")


def with_cutoffs(queries: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """Packed queries with each query's cutoff ``q, cutoff`` beside it; without one nothing is ruled out."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, classes in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                q = np.frombuffer(classes, "<i8")
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(q), block)), pa.array(np.arange(len(q))), pa.array(q)], ["block", "at", "q"])

    def packed_cutoffs(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("at")
        numbers = np.array([NO_CUTOFF if c is None else c for c in rows["cutoff"].to_pylist()], "<i8")
        return pa.table({"block": rows["block"][:1], "cutoffs": [numbers.tobytes()]})

    places = queries.select("block", "classes").mapInArrow(unpack, "block long, at long, q long").join(cutoffs, "q", "left")
    # A group is one packed block: QUERIES rows at most.
    return queries.join(places.groupBy("block").applyInArrow(packed_cutoffs, "block long, cutoffs binary"), "block")


def best_classes(vectors: DataFrame, queries: DataFrame, most: int) -> DataFrame:
    """``q, x, score``: for each row of ``queries`` (``class, vector``) its ``most`` best rows of ``vectors`` (``class, vector, least``).

    Of equal scores the one with the smaller ``least`` is better.
    """
    (candidates, parts), (asked, query_parts) = packed(vectors, CANDIDATES), packed(queries, QUERIES)
    tasks = parts * query_parts
    listed = _best(local_lists(_tiles(asked, query_parts, candidates, parts, STRIP), most), ["q", "run"], [F.desc("partial"), F.col("x")], most)
    # At most BLOCKS * most pairs of each query.
    listed = materialised(listed.groupBy("q_block", "block").agg(F.collect_set("at").alias("entries")))
    scored = resolved(listed, asked, candidates, tasks)
    enough = _best(scored, ["q"], [F.desc("score"), F.col("x")], most).where(F.col("_place") == most)
    asked = materialised(with_cutoffs(asked, enough.select("q", F.col("score").alias("cutoff"))))
    entries = materialised(sufficient_entries(_tiles(asked, query_parts, candidates, parts)))
    found = resolved(entries, asked, candidates, tasks)
    ordered = found.join(vectors.select(F.col("class").alias("x"), "least"), "x")
    return _best(ordered, ["q"], [F.desc("score"), F.asc_nulls_last("least"), F.col("x")], most).select("q", "x", "score")


def nearest(rows: DataFrame, is_query: Column, k: int, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """``query_id, rank, vec_id, score``: for every row that ``is_query`` the ``k`` other rows of greatest inner product.

    Components count as ``floor(64 * x)``. Ties go to the smaller key, a null key comes last. Rows with a null vector or a
    null or non-finite component take no part; a shorter vector counts as continued by zeros; an
    empty one scores 0. Each of several rows with one key is a query and a candidate
    of its own. Fewer than ``k`` other rows give as many; an empty table gives none. Other columns are ignored.
    """
    taken = rows.select(F.col(key).cast("long").alias("id"), F.coalesce(is_query, F.lit(False)).alias("asks"), whole_numbers(F.col(vector)).alias("vector"))
    taken = materialised(taken.where("vector is not null").withColumn("row", F.monotonically_increasing_id()))
    # The first k + 1 rows of each vector are all that can be among the best k others; queries are kept apart from them.
    first = F.asc_nulls_last("id"), F.col("row")
    members = _best(taken.select("vector", "id", "row"), ["vector"], list(first), k + 1)
    classes = materialised(members.where("_place = 1").select("vector", F.col("row").alias("class"), F.col("id").alias("least")))
    members = materialised(members.join(classes.select("vector", "class"), "vector").select("class", "id", "row"))
    asking = taken.where("asks").select(F.col("id").alias("query_id"), F.col("row").alias("query_row"), "vector")
    asking = materialised(asking.join(classes.select("vector", "class"), "vector").select("query_id", "query_row", F.col("class").alias("q")))
    queries = classes.join(asking.select(F.col("q").alias("class")).distinct(), "class", "left_semi").select("class", "vector")
    best = best_classes(classes, queries, k + 1)
    answers = best.join(members.withColumnRenamed("class", "x"), "x")
    answers = materialised(_best(answers, ["q"], [F.desc("score"), *first], k + 1).select("q", "score", "id", "row"))
    rest = asking.join(answers, "q").where("row <> query_row")
    ranked = _best(rest, ["query_row"], [F.desc("score"), *first], k)
    return ranked.select("query_id", F.col("_place").alias("rank"), F.col("id").alias("vec_id"), "score")
