"""Connected components by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionweave.llm.common import materialised


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _hung(both: DataFrame) -> DataFrame:
    """Rows (u, v) with the least neighbour of u (or u itself)."""
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    return both.join(least, "u")


def components(links: DataFrame) -> DataFrame:
    """``node, component`` of every node of the links ``u, v``: the least node it can reach.

    Each round hangs the greater neighbours of every node on its least neighbour and
    then its lesser ones; a component of n nodes ends as a star after about log n rounds.
    Every round is written, so a lost executor costs one round. A hub's neighbours are
    joined to one number and never gathered.
    """
    edges = links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    edges = materialised(edges)
    state = _state(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _hung(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = materialised(large)
        hung = _hung(large)
        small = hung.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(hung.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        edges = materialised(small)
        now = _state(edges)
        if now == state:
            break
        state = now
    roots = edges.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
