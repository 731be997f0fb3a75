"""Ordered work over sessions of any size.

One session may hold a large share of the log, so no window may hold a whole
session. A session with more than ``limit`` rows is cut into ordered chunks of
about ``limit / 2`` rows; windows run per (session, chunk) and the few values that
cross a chunk border are aggregated apart and joined back. The limit is the same
for every log, so no task's window grows with it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sessionweave.workspace import materialised

ROWS_PER_TASK = 1_000_000


@dataclass(frozen=True)
class SkewProfile:
    """Row total, rows of the largest session, and the size at which one is split."""

    total: int
    largest: int
    limit: int

    @property
    def has_hot(self) -> bool:
        return self.largest > self.limit

    @property
    def chunks(self) -> int:
        return max(2, -(-2 * self.largest // self.limit))


def profile(df: DataFrame, key: str = "session_id", rows_per_task: int = ROWS_PER_TASK) -> SkewProfile:
    """Measure the key sizes with one map-side-combined count over the key column."""
    row = (
        df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
        .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"), F.coalesce(F.max("n"), F.lit(0)).alias("largest"))
        .first()
    )
    return SkewProfile(row.total, row.largest, rows_per_task)


def keys_over(df: DataFrame, keys: list[str], rows: int) -> DataFrame:
    """Keys with more than ``rows`` rows: at most ``total / rows`` of them."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > rows).select(*keys)


def hot_keys(df: DataFrame, keys: list[str], skew: SkewProfile) -> DataFrame:
    """Keys above the profile's limit: at most ``total / limit``."""
    return keys_over(df, keys, skew.limit)


def _search(splits: Column, x: Column, chunks: int) -> Column:
    """Number of sorted ``splits`` below ``x``, by halving steps."""
    steps = F.array(*[F.lit(2**k) for k in reversed(range(chunks.bit_length()))])
    return F.aggregate(
        steps, F.lit(0), lambda lo, step: F.when(F.get(splits, lo + step - 1) < x, lo + step).otherwise(lo)
    )


def split_hot(df: DataFrame, keys: list[str], order: str, skew: SkewProfile) -> DataFrame:
    """Add ``_chunk`` (0 for an ordinary key) and ``_hot``; chunks follow ``order``.

    Split points come from a mergeable quantile sketch. Each key keeps as many as
    its own rows need, so all keys together hold at most ``3 * total / limit``.
    They are written before use: a sketch may come out differently when it is
    computed again, and all branches of a plan must cut at the same points.
    """
    hot = hot_keys(df, keys, skew)
    shares = [i / skew.chunks for i in range(1, skew.chunks)]
    sketches = (
        df.join(F.broadcast(hot), keys, "left_semi")
        .groupBy(*keys)
        .agg(F.percentile_approx(order, shares, 10 * skew.chunks).alias("_all"), F.count(F.lit(1)).alias("_rows"))
    )
    parts = F.least(F.ceil(2 * F.col("_rows") / skew.limit), F.lit(skew.chunks)).cast("int")
    splits = sketches.withColumn("_parts", parts).select(
        *keys,
        F.transform(
            F.sequence(F.lit(1), F.col("_parts") - 1),
            lambda i: F.get("_all", F.floor(i * skew.chunks / F.col("_parts")).cast("int") - 1),
        ).alias("_splits"),
    )
    splits = materialised(splits)
    return (
        df.join(F.broadcast(splits), keys, "left")
        .withColumn("_hot", F.col("_splits").isNotNull())
        .withColumn("_chunk", F.when(F.col("_hot"), _search(F.col("_splits"), F.col(order), skew.chunks)).otherwise(F.lit(0)))
        .drop("_splits")
    )


def with_neighbours(
    df: DataFrame, keys: list[str], order: str, columns: list[str], skew: SkewProfile, split_keys: list[str]
) -> DataFrame:
    """Add structs ``_prev`` and ``_next``: ``columns`` of the row before and after by ``order``.

    The struct is null where there is no such row, so a null value in it stays
    apart from a missing row. ``split_keys`` (a subset of ``keys``) decides which
    rows count as one hot key.
    """
    here = F.struct(*columns)
    if not skew.has_hot:
        w = Window.partitionBy(*keys).orderBy(order)
        return df.withColumn("_prev", F.lag(here).over(w)).withColumn("_next", F.lead(here).over(w))

    parts = split_hot(df, split_keys, order, skew)
    w = Window.partitionBy(*keys, "_chunk").orderBy(order)
    across = Window.partitionBy(*keys).orderBy("_chunk")
    # The ends of each chunk are found by plain minima and maxima, which need no sort; then only they are read.
    cell = [*keys, "_chunk"]
    hot = parts.where("_hot")
    bounds = hot.groupBy(*cell).agg(F.min(order).alias("_low"), F.max(order).alias("_high"))

    def end(mark: str) -> Column:
        return F.struct(*[F.max(F.when(F.col(order) == F.col(mark), F.col(c))).alias(c) for c in columns])

    ends = hot.join(F.broadcast(bounds), cell).where((F.col(order) == F.col("_low")) | (F.col(order) == F.col("_high")))
    edges = (
        ends.groupBy(*cell)
        .agg(end("_low").alias("_first"), end("_high").alias("_last"))
        .select(*cell, F.lag("_last").over(across).alias("_before"), F.lead("_first").over(across).alias("_after"))
    )
    return (
        parts.join(F.broadcast(edges), [*keys, "_chunk"], "left")
        .withColumn("_prev", F.coalesce(F.lag(here).over(w), F.col("_before")))
        .withColumn("_next", F.coalesce(F.lead(here).over(w), F.col("_after")))
        .drop("_before", "_after", "_chunk", "_hot")
    )


def with_positions(
    df: DataFrame, keys: list[str], order: str, skew: SkewProfile, totals: dict[str, Column] | None = None
) -> DataFrame:
    """Add ``_rn`` (1-based position by ``order``), ``_n`` (rows of the key) and ``totals``."""
    totals = {"_n": F.count(F.lit(1)), **(totals or {})}
    if not skew.has_hot:
        whole = Window.partitionBy(*keys)
        out = df.withColumn("_rn", F.row_number().over(whole.orderBy(order)))
        return out.withColumns({name: agg.over(whole) for name, agg in totals.items()})

    parts = split_hot(df, keys, order, skew)
    hot = parts.where("_hot")
    before = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        hot.groupBy(*keys, "_chunk")
        .agg(F.count(F.lit(1)).alias("_size"))
        .select(*keys, "_chunk", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    )
    wholes = hot.groupBy(*keys).agg(*[agg.alias(f"{name}_hot") for name, agg in totals.items()])
    chunk = Window.partitionBy(*keys, "_chunk")
    out = (
        parts.join(F.broadcast(offsets), [*keys, "_chunk"], "left")
        .join(F.broadcast(wholes), keys, "left")
        .withColumn("_rn", F.row_number().over(chunk.orderBy(order)) + F.coalesce(F.col("_offset"), F.lit(0)))
    )
    out = out.withColumns({name: F.coalesce(F.col(f"{name}_hot"), agg.over(chunk)) for name, agg in totals.items()})
    return out.drop("_offset", "_chunk", "_hot", *[f"{name}_hot" for name in totals])


def ntile(position: Column, rows: Column, buckets: int) -> Column:
    """SQL ``ntile`` (1-based) from a position and a row count."""
    small = F.floor(rows / buckets)
    extra = rows % buckets
    head = extra * (small + 1)
    return F.when(position <= head, F.floor((position - 1) / (small + 1)) + 1).otherwise(
        extra + F.floor((position - 1 - head) / F.greatest(small, F.lit(1))) + 1
    )


def join_sessions(
    rows: DataFrame, sessions: DataFrame, keys: list[str], how: str, skew: SkewProfile
) -> DataFrame:
    """Join event rows to a table with at most one row per ``keys``.

    Rows of hot sessions meet their few partner rows by broadcast, the rest by a
    plain join, so no task receives a whole hot session.
    """
    if not skew.has_hot:
        return rows.join(sessions, keys, how)
    hot = hot_keys(rows, keys[:1], skew)
    cold = rows.join(F.broadcast(hot), keys[:1], "left_anti").join(sessions, keys, how)
    warm = rows.join(F.broadcast(hot), keys[:1], "left_semi").join(
        F.broadcast(sessions.join(F.broadcast(hot), keys[:1], "left_semi")), keys, how
    )
    return cold.unionByName(warm)
