"""Per-session aggregates, overall and per value of a dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionweave.functions.expressions import matches
from sessionweave.presets import CATEGORY_COLUMNS, FQID_NONE, NUMERIC_COLUMNS, TEXT_FQID_NONE, FeatureParams

KEYS = ["session_id", "level_group"]
DIMENSIONS = ("event_name", "name", "room_fqid", "fqid", "text_fqid", "level", "level_group")
SENTINELS = {"fqid": FQID_NONE, "text_fqid": TEXT_FQID_NONE}


def session_counts(log: DataFrame) -> DataFrame:
    return log.groupBy(*KEYS).agg(F.count("idx").alias("session_number"))


def session_distincts(log: DataFrame, columns=CATEGORY_COLUMNS) -> DataFrame:
    """Distinct non-null values per category column.

    Each row becomes one (column, value) pair per column; pairs are made unique
    before they are counted, so the first shuffle carries one row per value.
    """
    pairs = log.select(*KEYS, *columns).unpivot(KEYS, list(columns), "dimension", "value").where("value is not null")
    return (
        pairs.distinct()
        .groupBy(*KEYS)
        .agg(*[F.count_if(F.col("dimension") == c).alias(f"{c}_unique") for c in columns])
    )


def numeric_stats(log: DataFrame, columns=NUMERIC_COLUMNS) -> DataFrame:
    return log.groupBy(*KEYS).agg(*numeric_aggregates(columns))


def numeric_aggregates(columns=NUMERIC_COLUMNS) -> list:
    kinds = {"mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    return [kind(c).alias(f"{c}_{name}") for c in columns for name, kind in kinds.items()]


def flag_aggregates(cuts) -> list:
    return [F.sum(f"elapsed_time_over{n}").alias(f"elapsed_time_over{n}") for n in cuts]


def gap_flag_sums(flagged: DataFrame, cuts) -> DataFrame:
    return flagged.groupBy(*KEYS).agg(*flag_aggregates(cuts))


def milestone_aggregates(params: FeatureParams) -> list:
    """Conditional spans of time and index; 0 where no row meets the rule."""
    out = []
    for rule in params.milestones:
        here = matches(rule.any_of) & (F.col("level_group") == rule.level_group)
        for column, name in (
            ("elapsed_time", f"{rule.name}_duration"),
            ("idx", f"{rule.index_name or rule.name}_indexCount"),
        ):
            inside = F.when(here, F.col(column))
            span = F.coalesce(F.max(inside) - F.min(inside), F.lit(0))
            out.append(F.when(F.col("level_group") == rule.level_group, span).alias(name))
    return out


def milestone_features(log: DataFrame, params: FeatureParams) -> DataFrame:
    return log.groupBy(*KEYS).agg(*milestone_aggregates(params))


def transition_aggregates(params: FeatureParams) -> list:
    """First row after minus last row before; null where either is missing."""
    out = []
    for rule in params.transitions:
        group = F.col("level_group") == rule.level_group
        for column, suffix in (("elapsed_time", "et"), ("idx", "id")):
            first_after = F.min(F.when(group & matches(rule.after), F.col(column)))
            last_before = F.max(F.when(group & matches(rule.before), F.col(column)))
            out.append((first_after - last_before).alias(f"{rule.name}_{suffix}"))
    return out


def milestone_transitions(log: DataFrame, params: FeatureParams) -> DataFrame:
    return log.groupBy(*KEYS).agg(*transition_aggregates(params))


def value_aggregates() -> list:
    et, x = "elapsed_time_diff", "location_x_diff"
    return [
        F.count(F.lit(1)).alias("n"),
        F.avg(et).alias("et_mean"),
        F.stddev_samp(et).alias("et_std"),
        F.max(et).alias("et_max"),
        F.min(et).alias("et_min"),
        F.sum(et).alias("et_sum"),
        F.avg(x).alias("x_mean"),
        F.stddev_samp(x).alias("x_std"),
        F.max(x).alias("x_max"),
        F.min(x).alias("x_min"),
    ]


def _value(dimension: str, params: FeatureParams):
    """The dimension as text, null where its value has no features."""
    value = F.col(dimension)
    listed = params.vocabularies.get(dimension) if dimension not in params.fitted else None
    if listed:
        value = F.when(value.isin(list(listed)), value)
    elif dimension in SENTINELS:
        value = F.when(value != SENTINELS[dimension], value)
    return value.cast("string")


def value_rows(log: DataFrame, dimensions, params: FeatureParams, columns) -> DataFrame:
    """One row per (event, dimension) with the value as text.

    ``word`` gives one dimension ``word_<w>`` per word found in the text.
    """
    values = {d: _value(d, params) for d in dimensions if d != "word"}
    if "word" in dimensions:
        values.update({f"word_{w}": F.when(F.contains(F.col("text"), F.lit(w)), w) for w in params.words})
    # An exploded array stays where its row is, so that a log bucketed by session needs no shuffle.
    cells = F.array(*[F.struct(F.lit(d).alias("dimension"), v.alias("value")) for d, v in values.items()])
    rows = log.select(*KEYS, *columns, F.explode(cells).alias("_cell"))
    return rows.select(*KEYS, *columns, "_cell.dimension", "_cell.value").where("value is not null")


def value_stats(log: DataFrame, dimensions, params: FeatureParams) -> DataFrame:
    """Count and gap/move statistics per (session, group, dimension, value).

    All dimensions share one shuffle; rows are combined before it, so a large
    session sends one row per value from each task.
    """
    rows = value_rows(log, dimensions, params, ["elapsed_time_diff", "location_x_diff"])
    table = rows.groupBy(*KEYS, "dimension", "value").agg(*value_aggregates())
    if "word" in dimensions:
        word = F.when(F.col("dimension").startswith("word_"), "word").otherwise(F.col("dimension"))
        table = table.withColumn("dimension", word)
    return table


def word_features(log: DataFrame, params: FeatureParams) -> DataFrame:
    return value_stats(log, ["word"], params)
