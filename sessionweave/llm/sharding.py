"""Reproducible shuffle into shards: a Feistel permutation over global row numbers.

Row numbers are the ranks of the rows in the order (hash bucket, key hash, key).
The permutation of ``0 .. N-1`` is an alternating Feistel network on ``Z_a x Z_b``
with ``a * b`` the least such product not below N; a value that falls outside the
range walks along its cycle until it is inside. Shard and slot follow from the
permuted number alone: ``shard = number % shards``, ``slot = number div shards``,
so shard sizes are at most one row apart, slots have no gaps, and a reader can
compute where any row number lies without a lookup.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from sessionweave.llm.common import materialised

#: Hash buckets for ranking; each holds about 1/16,384 of the distinct keys, and their counts are one small table.
BUCKETS = 1 << 14
ROUNDS = 6
#: Steps along a cycle. Up to 4,096 rows every cycle is shorter; beyond, the chance to need more is below 1e-115.
WALK = 64


def domain(n: int) -> tuple[int, int]:
    """Sides of the Feistel grid: a * b >= n with less than a cells too many."""
    a = max(1, math.isqrt(max(n, 1) - 1) + 1)
    return a, max(1, -(-n // a))


def _div(x: Column, by: int) -> Column:
    return F.call_function("div", x, F.lit(by).cast("long"))


def permute(number: Column, n: int, seed: int) -> Column:
    """Image of row ``number`` under the permutation of ``0 .. n-1`` chosen by ``seed``."""
    a, b = domain(n)

    def once(x: Column) -> Column:
        halves = F.struct(_div(x, b).alias("l"), (x % b).alias("r"))

        def turn(s: Column, k: Column) -> Column:
            even = (s["l"] + F.pmod(F.xxhash64(F.lit(seed), k, s["r"]), F.lit(a))) % a
            odd = (s["r"] + F.pmod(F.xxhash64(F.lit(seed), k, s["l"]), F.lit(b))) % b
            first = k % 2 == 0
            return F.struct(F.when(first, even).otherwise(s["l"]).alias("l"), F.when(first, s["r"]).otherwise(odd).alias("r"))

        rounds = F.array(*[F.lit(k) for k in range(ROUNDS)])
        return F.aggregate(rounds, halves, turn, lambda s: s["l"] * F.lit(b) + s["r"])

    def walk(x: Column, _: Column) -> Column:
        return F.when(x < n, x).otherwise(once(x))

    def inside(x: Column) -> Column:
        return F.when(x < n, x).otherwise(F.raise_error(F.lit("cycle walk too long")).cast("long"))

    steps = F.sequence(F.lit(1), F.lit(WALK))
    outside = lambda x, _: F.when(x < n, x).otherwise(F.aggregate(steps, x, walk, inside))
    return F.aggregate(F.array(F.lit(0)), once(number), outside)


def row_numbers(rows: DataFrame, columns: list[str]) -> tuple[DataFrame, int]:
    """``rows`` grouped into distinct values of ``columns`` with ``_count`` and the first global ``_number`` of each.

    Equal rows are counted before they move, so a value that a third of the rows
    share is one row here. Ranks need one window per hash bucket; bucket offsets
    come from a table of at most BUCKETS rows.
    """
    h = F.xxhash64(*[F.col(c) for c in columns])
    distinct = rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("_count")).withColumn("_h", h)
    distinct = materialised(distinct.withColumn("_bucket", F.pmod(F.col("_h"), F.lit(BUCKETS)).cast("int")))
    sizes = distinct.groupBy("_bucket").agg(F.sum("_count").alias("_rows"))
    before = W.orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.withColumn("_offset", F.coalesce(F.sum("_rows").over(before), F.lit(0)))  # at most BUCKETS rows
    inside = W.partitionBy("_bucket").orderBy("_h", *columns).rowsBetween(W.unboundedPreceding, -1)
    ranked = distinct.withColumn("_before", F.coalesce(F.sum("_count").over(inside), F.lit(0)))
    ranked = ranked.join(F.broadcast(offsets.select("_bucket", "_offset")), "_bucket")
    total = sizes.agg(F.sum("_rows")).first()[0] or 0
    return ranked.select(*columns, "_count", (F.col("_offset") + F.col("_before")).alias("_number")), total


def shard_rows(rows: DataFrame, shards: int, seed: int = 0) -> DataFrame:
    """``rows`` with ``shard`` and ``slot``: one output row for each input row, every column kept.

    Law ``rows``: shard counts are at most one apart. Equal rows get different
    places; which copy gets which cannot be told apart. Nulls are values like any
    other. An empty table gives an empty table. Columns named ``shard`` or
    ``slot`` in the input are replaced. The order of rows or files does not matter.
    """
    if shards < 1:
        raise ValueError("shards must be positive")
    columns = [c for c in rows.columns if c not in ("shard", "slot")]
    ranked, total = row_numbers(rows.select(*columns), columns)
    copies = F.explode(F.sequence(F.lit(0).cast("long"), F.col("_count") - 1))
    spread = ranked.select(*columns, "_number", copies.alias("_copy"))
    place = spread.withColumn("_place", permute(F.col("_number") + F.col("_copy"), max(total, 1), seed))
    shard, slot = (F.col("_place") % shards).cast("int"), _div(F.col("_place"), shards)
    return place.select(*columns, shard.alias("shard"), slot.cast("long").alias("slot"))


def document_shards(docs: DataFrame, shards: int = 24, seed: int = 7) -> DataFrame:
    """Shard and slot of every document, with the size and checksum of its text.

    Size is the UTF-8 length of the text (null: 0) plus 8. Only numbers are moved:
    the text is read once for its length and checksum.
    """
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    sized = docs.select("doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    placed = shard_rows(sized, shards, seed)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def write_shards(rows: DataFrame, shards: int, path: str, seed: int = 0) -> None:
    """Write each shard as its own folder ``shard=N`` with rows in slot order."""
    placed = shard_rows(rows, shards, seed)
    placed.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
