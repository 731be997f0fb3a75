"""Feature names and what they stand for.

Names are made from templates and the listed values of each dimension, so a table of
all names of a job resolves a name list by a join: name to (operator, value,
statistic, group), and back. Mined combinations are known by their form.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionweave.functions.expressions import time_parts
from sessionweave.operators import longtable, quantiles, stats
from sessionweave.operators.levels import level_time_texts
from sessionweave.presets import NAMES, FeatureParams

SHARES = (0.1, 0.2, 0.4, 0.6, 0.8, 0.9)
VALUE_SHARES = (0.2, 0.7, 0.9)
CATEGORIES = range(1, 6)
SCHEMA = "level_group string, feature string, operator string, value string, statistic string"

# Names of combinations that are mined, so that no list of them exists: they carry one of these
# endings (fixed values) and a level before it.
MINED = "^(.+)_(?:[0-9]+)(_ET_sum_|_counts|ET_count_)grp(.+)$"
RANDOM = "^random[0-9]+$"


def _rows(operator: str, templates, values) -> Iterator[tuple]:
    for value in values:
        for column, template, _ in templates:
            yield operator, template.replace("{c}", str(value)), str(value), column


def _group_names(params: FeatureParams, group: str) -> Iterator[tuple]:
    """``(operator, template, value, statistic)`` of every name of a group that needs no mining."""
    listed = {**params.vocabularies, "level": params.levels, "level_group": params.level_groups, "word": params.words}
    plain = "{c}_{S}"
    yield from _rows("session_counts", [("n", "session_number_{S}", True)], [""])
    yield from _rows("session_distincts", [("unique", "{c}_unique_{S}", False)], stats.CATEGORY_COLUMNS)
    for column in stats.NUMERIC_COLUMNS:
        yield from _rows("numeric_quantiles", [(f"quantile{round(s * 10)}", quantiles.quantile_name("{c}", s) + "_{S}", False) for s in SHARES], [column])
        yield from _rows("numeric_stats", [(k, f"{{c}}_{k}_{{S}}", False) for k in ("mean", "std", "min", "max")], [column])
    for dimension, templates in longtable.VALUE_TEMPLATES.items():
        yield from _rows(f"by_{dimension}", templates, listed.get(dimension, ()))
    shares = [(f"quantile{round(s * 10)}", f"{{c}}_ET_quantile{round(s * 10)}_{{S}}", False) for s in SHARES]
    yield from _rows("by_event_name_quantiles", shares, listed.get("event_name", ()))
    if params.level_diff:
        yield from _rows("level_times", [("time", plain, False)], level_time_texts(params))
    if params.cut_above and group in params.above_groups:
        late = [*listed.get("room_fqid", ()), *listed.get("event_name", ()), *params.levels]
        yield from _rows("above_threshold", longtable.ABOVE_TEMPLATES, late)
    if params.extra:
        for rule in params.milestones:
            if rule.level_group == group:
                yield from _rows("milestones", [("duration", "{c}_duration_extra_{S}", False)], [rule.name])
                yield from _rows("milestones", [("indexCount", "{c}_indexCount_extra_{S}", False)], [rule.index_name or rule.name])
        for rule in params.transitions:
            if rule.level_group == group:
                yield from _rows("transitions", [(k, f"{{c}}_{k}_extra_{{S}}", False) for k in ("et", "id")], [rule.name])
    if params.version >= 2:
        levels = [f"{event}_{level}" for event in params.event_level_events for level in params.levels]
        pairs = [f"{event}_{name}" for event in params.pair_events for name in listed.get("name") or NAMES]
        yield from _rows("event_level_counts", longtable.COUNT_TEMPLATES, levels)
        yield from _rows("event_name_pair_counts", longtable.COUNT_TEMPLATES, pairs)
        yield from _rows("repeat_clicks", [("n", plain, False)], ["click_same_max", "click_same_over"])
    if params.version >= 3:
        yield from _rows("gap_flags", [("sum", "elapsed_time_over{c}_{S}", False)], params.gap_flags)
    if params.version >= 4:
        for dimension, tag in (("text_fqid", "text"), ("room_fqid", "room")):
            shares = [(f"quantile{round(s * 10)}", f"{{c}}_{tag}_ET_quantile{round(s * 10)}_{{S}}", False) for s in VALUE_SHARES]
            yield from _rows(f"by_{tag}_quantiles", shares, listed.get(dimension, ()))
    if params.room_click:
        cells = [f"{room}_{category}" for room in listed.get("room_fqid", ()) for category in CATEGORIES]
        yield from _rows("navigate_category_counts", longtable.NAVIGATE_TEMPLATES, cells)


def feature_names(spark: SparkSession, params: FeatureParams) -> DataFrame:
    """Every name of a job but those of mined combinations, with operator, value, statistic and group.

    A parameter table: its size follows from the listed values alone.
    """
    rows = [
        (group, template.replace("{S}", f"grp{group}"), operator, value, statistic)
        for group in params.level_groups
        for operator, template, value, statistic in _group_names(params, group)
    ]
    return spark.createDataFrame(rows, SCHEMA)


def resolve_names(names: DataFrame, params: FeatureParams) -> DataFrame:
    """``names`` (``feature``, perhaps as earlier lists spell it) with ``current`` and what it stands for.

    ``operator`` is null for a name that no template gives. Milestones are also known without the
    mark and group of their kind, time parts and noise have no group.
    """
    spark = names.sparkSession
    asked = names.select("feature").distinct()
    current = longtable.current_names(asked.withColumn("_old", F.col("feature"))).select(F.col("_old").alias("feature"), F.col("feature").alias("current"))
    known = feature_names(spark, params)
    short = known.where(F.col("operator").isin("milestones", "transitions")).withColumn("feature", F.regexp_replace("feature", "_extra_grp.*$", ""))
    parts = spark.createDataFrame([(None, p, "time_parts", p, None) for p in time_parts(F.lit(0))], SCHEMA)
    # Tables of parameters.
    table = known.unionByName(short).unionByName(parts).withColumnRenamed("feature", "current")
    found = current.join(F.broadcast(table), "current", "left")
    mined, noise = F.col("current").rlike(MINED), F.col("current").rlike(RANDOM)
    missing = F.col("operator").isNull()
    kind = F.regexp_extract("current", MINED, 2)
    return found.select(
        "feature",
        "current",
        F.when(missing & mined, F.regexp_extract("current", MINED, 3)).otherwise(F.col("level_group")).alias("level_group"),
        F.when(missing & mined, F.lit("combo_features")).when(missing & noise, F.lit("noise_features")).otherwise(F.col("operator")).alias("operator"),
        F.when(missing & mined, F.regexp_extract("current", "^(.+_[0-9]+)(_ET_sum_|_counts|ET_count_)grp", 1)).otherwise(F.col("value")).alias("value"),
        F.when(missing & mined, F.when(kind == "_ET_sum_", "et_sum").otherwise("n")).otherwise(F.col("statistic")).alias("statistic"),
    )
