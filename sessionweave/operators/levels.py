"""Level times, end-of-group thresholds and the features of rows past them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sessionweave.operators.skew import SkewProfile, join_sessions
from sessionweave.operators.stats import KEYS, value_rows
from sessionweave.presets import FeatureParams


def level_times(log: DataFrame) -> DataFrame:
    """Start, end, total and gap to the next level per (session, group, level).

    The window runs over one row per level of a session within a group.
    """
    spans = log.groupBy(*KEYS, "level").agg(
        F.max("elapsed_time").alias("elapsed_time_max"), F.min("elapsed_time").alias("elapsed_time_min")
    )
    following = Window.partitionBy(*KEYS).orderBy("level")
    return spans.withColumns(
        {
            "elapsed_time_total": F.col("elapsed_time_max") - F.col("elapsed_time_min"),
            "next_min": F.lead("elapsed_time_min").over(following),
        }
    ).withColumn("level_diff", F.col("next_min") - F.col("elapsed_time_max"))


def level_time_texts(params: FeatureParams) -> dict[str, str]:
    """SQL text of each aggregate over a session's level times, by name."""

    def at(column, low, high):
        return f"case when level between {low} and {high} then {column} end"

    def one_sided(text, limit):
        # ``least`` and ``greatest`` skip nulls; a missing gap stays missing.
        return f"case when {text} is not null then {limit}({text}, 0) end"

    out = {f"elapsed_time_total_level_{n}": f"max({at('elapsed_time_total', n, n)})" for n in params.levels}
    for n in params.levels:
        if n not in params.no_gap_levels:
            out[f"elapsed_time_level_diff_fixed_{n}"] = one_sided(f"max({at('level_diff', n, n)})", "least")
    for low, high in params.level_ranges:
        out[f"elapsed_time_max{low}-{high}"] = f"max({at('elapsed_time_max', low, high)})"
    for low, high in params.level_ranges:
        late = f"(max({at('elapsed_time_max', low, high - 1)}) - min({at('elapsed_time_min', high, high)}))"
        dash = "_" if low == 0 else "-"
        out[f"elapsed_time_diff_fixed_max{low}{dash}{high - 1}_min{high}"] = one_sided(late, "greatest")
    return out


def level_time_aggregates(params: FeatureParams) -> list:
    return [F.expr(text).alias(name) for name, text in level_time_texts(params).items()]


def level_time_features(log: DataFrame, params: FeatureParams) -> DataFrame:
    return level_times(log).groupBy(*KEYS).agg(*level_time_aggregates(params))


def session_thresholds(log: DataFrame, params: FeatureParams) -> DataFrame:
    """Start of the group's last level plus the group's add-on; null without that level."""
    starts = (
        log.where(F.col("level").isin(list(params.end_levels)))
        .groupBy(*KEYS, "level")
        .agg(F.min("elapsed_time").alias("start"))
        .groupBy(*KEYS)
        .agg(F.max("start").alias("start"))
    )
    group = F.col("level_group")
    add_on = F.coalesce(*[F.when(group == g, F.lit(n)) for g, n in params.group_add_on.items()])
    return starts.select(*KEYS, (F.col("start") + add_on).alias("max_threshold"))


def above_threshold_rows(log: DataFrame, params: FeatureParams, skew: SkewProfile) -> DataFrame:
    """Rows later than their session's threshold; sessions without one drop out."""
    limits = session_thresholds(log, params)
    return join_sessions(log, limits, KEYS, "inner", skew).where("elapsed_time > max_threshold").drop("max_threshold")


def above_threshold_features(log: DataFrame, params: FeatureParams, skew: SkewProfile) -> DataFrame:
    """Count and time per room, event and level over the rows past the threshold."""
    rows = value_rows(
        above_threshold_rows(log, params, skew), ["room_fqid", "event_name", "level"], params, ["elapsed_time_diff_to"]
    )
    return rows.groupBy(*KEYS, "dimension", "value").agg(
        F.count(F.lit(1)).alias("n"), F.sum("elapsed_time_diff_to").alias("diff_to_sum")
    )
