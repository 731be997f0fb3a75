"""Value combinations: mined dictionaries and their per-session features.

Events are first reduced to one row per (session, combination). That table gives
both the features and the support, which is then a plain row count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sessionweave.operators.stats import KEYS
from sessionweave.presets import NAMES, FeatureParams

FQID_COMBO = ["fqid", "level", "room_fqid"]
TEXT_COMBO = ["text_fqid", "level"]


def combo_cells(log: DataFrame, combo: list[str]) -> DataFrame:
    return log.groupBy(*KEYS, *combo).agg(F.sum("elapsed_time_diff").alias("et_sum"), F.count("idx").alias("n"))


def group_sessions(log: DataFrame) -> DataFrame:
    """Sessions per level group: at most one row per group."""
    return log.select(*KEYS).distinct().groupBy("level_group").agg(F.count(F.lit(1)).alias("sessions"))


def mine_combos(cells: DataFrame, sessions: DataFrame, combo: list[str], support: float) -> DataFrame:
    """Combinations seen in enough sessions, without first values left with only one.

    ``fit`` step: the result is the dictionary that ``combo_features`` applies,
    also to a log other than the one it was mined from.
    """
    # The product is rounded first: a share such as 1 - 0.97 is not an exact 0.03.
    least = F.floor(F.round(F.col("sessions") * F.lit(support), 9))
    frequent = (
        cells.groupBy("level_group", *combo)
        .agg(F.count(F.lit(1)).alias("support"))
        .join(F.broadcast(sessions), "level_group")
        .where(F.col("support") >= least)
        .drop("sessions")
    )
    alike = Window.partitionBy("level_group", combo[0])
    return frequent.withColumn("_alike", F.count(F.lit(1)).over(alike)).where("_alike > 1").drop("_alike")


def frequent_fqid_level_room(log: DataFrame, params: FeatureParams) -> DataFrame:
    return mine_combos(combo_cells(log, FQID_COMBO), group_sessions(log), FQID_COMBO, params.support)


def frequent_text_level(log: DataFrame, params: FeatureParams) -> DataFrame:
    return mine_combos(combo_cells(log, TEXT_COMBO), group_sessions(log), TEXT_COMBO, params.text_support)


def combo_features(cells: DataFrame, dictionary: DataFrame, combo: list[str]) -> DataFrame:
    """Per-session time and count of the dictionary's combinations.

    Both sides are aggregates; the planner broadcasts the dictionary when its
    measured size is below the session's threshold.
    """
    return cells.join(dictionary.select("level_group", *combo), ["level_group", *combo], "left_semi")


def event_level_counts(log: DataFrame, params: FeatureParams) -> DataFrame:
    return (
        log.where(F.col("event_name").isin(list(params.event_level_events)))
        .groupBy(*KEYS, "event_name", "level")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def event_name_pair_counts(log: DataFrame, params: FeatureParams) -> DataFrame:
    names = list(params.vocabularies.get("name") or NAMES)
    return (
        log.where(F.col("event_name").isin(list(params.pair_events)) & F.col("name").isin(names))
        .groupBy(*KEYS, "event_name", "name")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def event_pair_counts(log: DataFrame, params: FeatureParams) -> DataFrame:
    """Counts per (event, level) and per (event, name) in one pass, each pair as one text."""
    names = list(params.vocabularies.get("name") or NAMES)
    event = F.col("event_name")
    pairs = log.select(
        *KEYS,
        F.when(event.isin(list(params.event_level_events)), F.concat_ws("_", event, F.col("level").cast("string"))).alias("_level"),
        F.when(event.isin(list(params.pair_events)) & F.col("name").isin(names), F.concat_ws("_", event, "name")).alias("_name"),
    )
    rows = pairs.unpivot(KEYS, ["_level", "_name"], "kind", "pair").where("pair is not null")
    return rows.groupBy(*KEYS, "pair").agg(F.count(F.lit(1)).alias("n"))
