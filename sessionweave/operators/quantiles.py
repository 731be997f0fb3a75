"""Exact nearest-rank quantiles per group.

Where sessions are small, a group gathers its values into one sorted array.
Large sessions are ranked on their value counts instead: equal values merge
before the shuffle, and the distinct values of a hot group are cut into chunks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sessionweave.functions.expressions import nearest_index
from sessionweave.operators.skew import SkewProfile, keys_over, split_hot
from sessionweave.workspace import materialised


# The largest session whose values may sit in arrays: a task gathers several such sessions at a time.
ARRAY_ROWS = 20_000


def quantile_name(column: str, share: float) -> str:
    return f"{column}_quantile{round(share * 10)}"


def nearest_quantiles(
    df: DataFrame,
    keys: list[str],
    columns: list[str],
    shares,
    skew: SkewProfile,
    session: str = "session_id",
    array_rows: int = ARRAY_ROWS,
) -> DataFrame:
    """One row per key with ``<column>_quantile<10*share>`` columns.

    ``array_rows`` is the largest session whose values may sit in one array.
    """
    if skew.largest <= array_rows:
        return _by_arrays(df, keys, columns, shares)
    if array_rows <= 0:
        return _by_counts(df, keys, columns, shares, skew)
    large = materialised(keys_over(df, [session], array_rows))  # its size decides how it is joined
    small_rows, large_rows = df.join(large, [session], "left_anti"), df.join(large, [session], "left_semi")
    return _by_arrays(small_rows, keys, columns, shares).unionByName(_by_counts(large_rows, keys, columns, shares, skew))


def _by_arrays(df, keys, columns, shares):
    sorted_values = df.groupBy(*keys).agg(*[F.array_sort(F.collect_list(c)).alias(c) for c in columns])
    picks = [
        f"get(`{c}`, cast(floor((size(`{c}`) - 1) * {float(s)}D + 0.5D) as int)) as `{quantile_name(c, s)}`"
        for c in columns
        for s in shares
    ]
    return sorted_values.selectExpr(*keys, *picks)


def _by_counts(df, keys, columns, shares, skew):
    types = dict(df.dtypes)
    values = df.select(*keys, *[F.col(c).cast("double").alias(c) for c in columns]).unpivot(
        keys, list(columns), "column", "x"
    )
    cell = [*keys, "column"]
    counts = values.where("x is not null").groupBy(*cell, "x").agg(F.count(F.lit(1)).alias("c"))
    parts = split_hot(counts, cell, "x", skew).drop("_hot")

    sizes = parts.groupBy(*cell, "_chunk").agg(F.sum("c").alias("_size"))
    whole = Window.partitionBy(*cell)
    before = whole.orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("_offset", F.coalesce(F.sum("_size").over(before), F.lit(0))).withColumn(
        "_n", F.sum("_size").over(whole)
    )
    wanted = F.array(
        *[F.struct(F.lit(float(s)).alias("share"), (nearest_index(F.col("_n"), s) + 1).alias("rank")) for s in shares]
    )
    targets = (
        sizes.withColumn("_t", F.explode(wanted))
        .where((F.col("_t.rank") > F.col("_offset")) & (F.col("_t.rank") <= F.col("_offset") + F.col("_size")))
        .groupBy(*cell, "_chunk")
        .agg(F.first("_offset").alias("_offset"), F.collect_list("_t").alias("_targets"))
    )
    running = Window.partitionBy(*cell, "_chunk").orderBy("x").rowsBetween(Window.unboundedPreceding, 0)
    picked = (
        parts.join(targets, [*cell, "_chunk"])
        .withColumn("_upto", F.sum("c").over(running) + F.col("_offset"))
        .withColumn("_t", F.explode("_targets"))
        .where((F.col("_t.rank") <= F.col("_upto")) & (F.col("_t.rank") > F.col("_upto") - F.col("c")))
    )
    found = picked.groupBy(*keys).agg(
        *[
            F.max(F.when((F.col("column") == c) & (F.col("_t.share") == float(s)), F.col("x")))
            .cast(types[c])
            .alias(quantile_name(c, s))
            for c in columns
            for s in shares
        ]
    )
    return df.select(*keys).distinct().join(found, keys, "left")
