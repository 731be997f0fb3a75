"""The long feature table: ``(session_id, level_group, block, feature, zero, value)``.

Only cells with a value have a row. ``zero`` marks counts: for them a missing row
means 0 if the session belongs to the block, and null otherwise; for all other
features it means null. Names follow the wide table's column names.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from sessionweave.functions.expressions import time_parts
from sessionweave.operators.stats import KEYS
from sessionweave.workspace import scratch_path
from sessionweave.presets import NULL_RATE, NULL_RATE_ABOVE, FeatureParams

# Name templates (fixed values): {c} is the dimension's value, {S} the group suffix.
# Each entry is (source column, template, count?).
_FULL = ("std", "mean", "max", "min", "sum")
VALUE_TEMPLATES = {
    "event_name": [("n", "{c}_event_name_counts{S}", True)]
    + [(f"et_{k}", "{c}_ET_" + k + "_{S}", False) for k in ("mean", "std", "max", "min")]
    + [(f"x_{k}", "{c}_ET_" + k + "_x{S}", False) for k in ("mean", "std", "max", "min")],
    "name": [("n", "{c}_name_counts{S}", True)]
    + [(f"et_{k}", "{c}_ET_" + k + "_{S}", False) for k in ("mean", "max", "min", "std")],
    "room_fqid": [("n", "{c}_room_fqid_counts{S}", True)] + [(f"et_{k}", "{c}_ET_" + k + "_{S}", False) for k in _FULL],
    "fqid": [("n", "{c}_fqid_counts{S}", True)] + [(f"et_{k}", "{c}_ET_" + k + "_{S}", False) for k in _FULL],
    "text_fqid": [("n", "{c}_text_fqid_counts{S}", True)] + [(f"et_{k}", "{c}_ET_" + k + "_{S}", False) for k in _FULL],
    "level": [("n", "{c}_LEVEL_count{S}", True)] + [(f"et_{k}", "{c}_ET_" + k + "_{S}", False) for k in ("std", "mean", "sum")],
    "level_group": [("n", "{c}_LEVEL_group_count{S}", True)]
    + [(f"et_{k}", "{c}_ET_" + k + "_{S}", False) for k in ("std", "mean", "sum")],
    "word": [("n", "word_{c}_{S}", True)]
    + [(f"et_{k}", "word_" + k + "_{c}_{S}", False) for k in ("mean", "std", "max", "sum")],
}
ABOVE_TEMPLATES = [("n", "index_count_{c}_{S}_above", True), ("diff_to_sum", "elapsed_time_diff_to_{c}_{S}_above", False)]
FQID_COMBO_TEMPLATES = [("et_sum", "{c}_ET_sum_{S}", False), ("n", "{c}_counts{S}", True)]
TEXT_COMBO_TEMPLATES = [("et_sum", "{c}_ET_sum_{S}", False), ("n", "{c}ET_count_{S}", True)]
COUNT_TEMPLATES = [("n", "{c}_count_{S}", True)]
NAVIGATE_TEMPLATES = [("n", "navigate_index_count{c}_{S}", True)]

# Names that differ from the published lists because the lists carry slips.
RENAMED = {
    "{event}_{level}_ET_min_{S}": "{event}_{level}_count_{S}",
    "click_same_over5_count_{S}": "click_same_over_{S}",
}


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _name_sql(template: str, value: str | None) -> str:
    """SQL text of a feature name: ``{c}`` is the column ``value``, ``{S}`` the group suffix."""
    pieces = []
    for piece in re.split(r"(\{c\}|\{S\})", template):
        if piece == "{c}":
            pieces.append(value)
        elif piece == "{S}":
            pieces.append("'grp', level_group")
        elif piece:
            pieces.append(_quoted(piece))
    return f"concat({', '.join(pieces)})"


def _cells_sql(templates, value: str | None = None) -> str:
    """SQL text of an array with one (feature, zero, value) struct per template.

    Text keeps the driver quick: a block may have hundreds of features.
    """
    cells = [
        f"named_struct('feature', {_name_sql(template, value)}, 'zero', {str(zero).lower()}, 'value', cast(`{column}` as double))"
        for column, template, zero in templates
    ]
    return f"cast(array({', '.join(cells)}) as array<struct<feature:string,zero:boolean,value:double>>)"


def melt(df: DataFrame, block: str, templates, value: Column | None = None) -> DataFrame:
    """Long rows of a table with one row per session (or per session and ``value``)."""
    if value is not None:
        df = df.withColumn("_c", value.cast("string"))
    return _long(df, block, F.expr(_cells_sql(templates, "_c")))


def melt_values(stats: DataFrame, dimensions, templates=None) -> DataFrame:
    """Long rows of a table with (dimension, value) rows: each dimension has its own templates."""
    templates = templates or VALUE_TEMPLATES
    branches = [f"when {_quoted(d)} then {_cells_sql(templates[d], 'value')}" for d in dimensions]
    return _long(stats, "base", F.expr(f"case dimension {' '.join(branches)} end"))


def _long(df: DataFrame, block: str, cells: Column) -> DataFrame:
    return (
        df.select(*KEYS, F.lit(block).alias("block"), F.explode(cells).alias("cell"))
        .select(*KEYS, "block", "cell.feature", "cell.zero", "cell.value")
        .where("value is not null")
    )


def melt_columns(df: DataFrame, block: str = "base", pattern: str = "{column}_{S}", zero: bool = False) -> DataFrame:
    """Long rows of a session table whose column names become feature names."""
    names = [c for c in df.columns if c not in KEYS]
    return melt(df, block, [(c, pattern.replace("{column}", c), zero) for c in names])


def stack_blocks(blocks: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, blocks)


# --- members, pruning, catalogue ---------------------------------------------


def block_members(log: DataFrame, **blocks: DataFrame) -> DataFrame:
    """Distinct ``(level_group, block, session_id)``: every session is in ``base``."""
    members = [log.select(*KEYS, F.lit("base").alias("block"))]
    members += [rows.select(*KEYS, F.lit(name).alias("block")) for name, rows in blocks.items()]
    return reduce(DataFrame.unionByName, members).distinct()


def listed_counts(spark: SparkSession, params: FeatureParams) -> DataFrame:
    """Names of the counts that ``above`` and ``navigate`` have even where no session has a row for them.

    Such a count is 0 for the block's members and null for the others, so it still
    tells them apart. Only listed values can be known without a row.
    """
    names = []
    rooms = list(params.vocabularies.get("room_fqid") or ())
    events = list(params.vocabularies.get("event_name") or ())
    if params.cut_above:
        for group in params.above_groups:
            names += [(group, "above", f"index_count_{v}_grp{group}_above", True) for v in [*params.levels, *rooms, *events]]
    if params.room_click:
        for group in params.level_groups:
            names += [
                (group, "navigate", f"navigate_index_count{room}_{category}_grp{group}", True)
                for room in rooms
                for category in range(1, 6)
            ]
    return spark.createDataFrame(names, "level_group string, block string, feature string, zero boolean")


def carry_names(names: DataFrame, order) -> DataFrame:
    """The names each group has after ``merge_groups``."""
    out = [names]
    for i, group in enumerate(order):
        own = names.where(F.col("level_group") == group).withColumn("block", F.concat("block", F.lit(f"@{group}")))
        out += [own.withColumn("level_group", F.lit(later)) for later in order[i + 1 :]]
    return stack_blocks(out)


def feature_summary(features: DataFrame, members: DataFrame, listed: DataFrame | None = None) -> DataFrame:
    """Null rate and spread of every feature, from one aggregation over the long rows.

    The implicit zeros and nulls come from the block sizes (a few rows). ``listed``
    adds names that may have no row.
    """
    features = features.select("level_group", "block", "feature", "zero", "value")
    if listed is not None:
        names = listed.select("level_group", "block", "feature", "zero", F.lit(None).cast("double").alias("value"))
        features = features.unionByName(names)
    sizes = members.groupBy("level_group", "block").agg(F.count(F.lit(1)).alias("members"))
    totals = sizes.where("block = 'base'").select("level_group", F.col("members").alias("sessions"))
    rows = features.groupBy("level_group", "block", "feature", "zero").agg(
        F.count("value").alias("n"), F.min("value").alias("low"), F.max("value").alias("high")
    )
    rows = rows.join(F.broadcast(sizes), ["level_group", "block"]).join(F.broadcast(totals), "level_group")
    padded = F.col("zero") & (F.col("n") < F.col("members"))
    return rows.select(
        "level_group",
        "block",
        "feature",
        "zero",
        "sessions",
        F.when(F.col("zero"), F.col("members")).otherwise(F.col("n")).alias("present"),
        F.when(padded, F.least("low", F.lit(0.0))).otherwise(F.col("low")).alias("low"),
        F.when(padded, F.greatest("high", F.lit(0.0))).otherwise(F.col("high")).alias("high"),
    )


def prune(summary: DataFrame, null_rate: float = NULL_RATE, null_rate_above: float = NULL_RATE_ABOVE) -> DataFrame:
    """Keep features that are present often enough and not constant (null counts as a value)."""
    missing = F.col("sessions") - F.col("present")
    limit = F.when(F.col("feature").endswith("_above"), F.lit(null_rate_above)).otherwise(F.lit(null_rate))
    enough = missing / F.col("sessions") <= F.greatest(limit, F.lit(null_rate))
    varies = (F.col("low") < F.col("high")) | (missing > 0)
    return summary.where(enough & varies)


def keep_features(features: DataFrame, kept: DataFrame) -> DataFrame:
    return features.join(kept.select("level_group", "feature"), ["level_group", "feature"], "left_semi")


def drop_listed(table: DataFrame, names: DataFrame) -> DataFrame:
    """Drop the features of a name table, in the groups it names or, without ``level_group``, in all; unknown names do nothing."""
    keys = [c for c in ("level_group", "feature") if c in names.columns]
    return table.join(names.select(*keys).distinct(), keys, "left_anti")


def current_names(names: DataFrame) -> DataFrame:
    """A name table with the names of RENAMED replaced by those in use."""
    shapes = {"event": "(.+)", "level": "([0-9]+)", "S": "(grp.+)"}
    feature = F.col("feature")
    for old, new in RENAMED.items():
        fields = re.findall(r"\{(\w+)\}", old)
        pattern = "^" + re.sub(r"\{(\w+)\}", lambda m: shapes[m[1]], old) + "$"
        feature = F.regexp_replace(feature, pattern, re.sub(r"\{(\w+)\}", lambda m: f"${fields.index(m[1]) + 1}", new))
    return names.withColumn("feature", feature)


def feature_catalog(summary: DataFrame, kept: DataFrame) -> DataFrame:
    """Every feature name of a group and whether it was kept."""
    marks = kept.select("level_group", "feature", F.lit(True).alias("kept"))
    return summary.select("level_group", "feature").join(marks, ["level_group", "feature"], "left").fillna({"kept": False})


def time_rows(members: DataFrame, parts: int | None) -> DataFrame:
    """Time parts of the session id as features: the first ``parts``; 8 leaves out the year; 0 or None gives none."""
    columns = time_parts(F.col("session_id"))
    if parts == 8:
        chosen = [n for n in columns if n != "year"]
    else:
        chosen = list(columns)[: parts or 0]
    sessions = members.where("block = 'base'").select(*KEYS)
    return melt_columns(sessions.select(*KEYS, *[columns[n].alias(n) for n in chosen]), pattern="{column}")


def merge_groups(features: DataFrame, members: DataFrame, order) -> tuple[DataFrame, DataFrame]:
    """Give each later group the merged features of the group before it, for its own sessions.

    Carried rows change their group and mark their block with the group they came
    from, so that implicit zeros still follow the original block's members. A row goes
    on from group to group as long as its session is in the next one: each session has an
    array of groups for each group it starts from, and every row is expanded by it once.
    """
    places = {group: i for i, group in enumerate(order)}
    place = F.coalesce(*[F.when(F.col("level_group") == g, F.lit(i)) for g, i in places.items()])
    inside = members.where("block = 'base'").groupBy("session_id").agg(F.collect_set(place).alias("_places"))
    spans = []
    for start, group in enumerate(order):
        # The groups from here on without a gap.
        reached = [F.lit(group)]
        unbroken = F.lit(True)
        for later in range(start + 1, len(order)):
            unbroken = unbroken & F.array_contains("_places", later)
            reached.append(F.when(unbroken, F.lit(order[later])))
        spans.append(F.struct(F.lit(group).alias("level_group"), F.array_compact(F.array(*reached)).alias("_groups")))
    onward = inside.select("session_id", F.explode(F.array(*spans)).alias("_span")).select("session_id", "_span.*")
    return _expanded(features, onward), _expanded(members, onward)


def _expanded(rows: DataFrame, onward: DataFrame) -> DataFrame:
    group = F.explode("_groups").alias("_group")
    spread = rows.join(onward, ["session_id", "level_group"]).select(*rows.columns, group)
    own = F.col("_group") == F.col("level_group")
    block = F.when(own, F.col("block")).otherwise(F.concat("block", F.lit("@"), "level_group"))
    changed = {"level_group": F.col("_group"), "block": block}
    return spread.select(*[changed.get(c, F.col(c)).alias(c) for c in rows.columns])


# --- vectors ------------------------------------------------------------------


def feature_index(kept: DataFrame) -> DataFrame:
    """``level_group, feature, block, zero, index``: the place of each kept feature in its group's vectors, by name."""
    by_name = Window.partitionBy("level_group").orderBy("feature", "block")
    return kept.select("level_group", "feature", "block", "zero", (F.row_number().over(by_name) - 1).alias("index"))


def sparse_cells(features: DataFrame, members: DataFrame, index: DataFrame) -> DataFrame:
    """``session_id, level_group, indices, values``: one row per session of a group, straight from the long rows.

    A missing value stands below every other, as a fill of -1 would put it. Here everything
    moves up by one instead, so that missing values are 0 and need no cell; a tree splits
    the same sessions either way. Counts keep their zeros, and only sessions outside
    the block get -1. A session with two values of one feature is an error.
    """
    value = F.when(F.col("zero"), F.col("value")).otherwise(F.col("value") + 1)
    places = index.select("level_group", "feature", "index")
    cells = features.join(places, ["level_group", "feature"]).select(*KEYS, "index", value.alias("value")).where("value <> 0")
    # One row per (group, block) with counts.
    counted = index.where("zero").groupBy("level_group", "block").agg(F.collect_list("index").alias("_counts"))
    base = members.where("block = 'base'").select(*KEYS)
    outside = base.join(F.broadcast(counted), "level_group").join(members.select(*KEYS, "block"), [*KEYS, "block"], "left_anti")
    cells = cells.unionByName(outside.select(*KEYS, F.explode("_counts").alias("index"), F.lit(-1.0).alias("value")))
    arrays = cells.groupBy(*KEYS).agg(F.array_sort(F.collect_list(F.struct("index", "value"))).alias("_cells"))
    indices = F.coalesce("_cells.index", F.array().cast("array<int>"))
    twice = F.size(F.array_distinct(indices)) < F.size(indices)
    return base.join(arrays, KEYS, "left").select(
        *KEYS,
        F.when(twice, F.raise_error(F.lit("two values of one feature in a session"))).otherwise(indices).alias("indices"),
        F.coalesce("_cells.value", F.array().cast("array<double>")).alias("values"),
    )


def with_vectors(cells: DataFrame, index: DataFrame) -> DataFrame:
    """``session_id, level_group, features``: the cells as sparse vectors, written.

    The parts of a vector are written as Parquet and read back as its type, which needs no Python worker.
    """
    spark, path = cells.sparkSession, scratch_path(cells.sparkSession)
    sizes = index.groupBy("level_group").agg(F.count(F.lit(1)).cast("int").alias("_size"))
    sparse = F.struct(F.lit(0).cast("tinyint").alias("type"), F.col("_size").alias("size"), "indices", "values")
    # One row per group.
    cells.join(F.broadcast(sizes), "level_group").select(*KEYS, sparse.alias("features")).write.partitionBy("level_group").parquet(path)
    keys = [f for f in cells.schema.fields if f.name == "session_id"]
    schema = StructType([*keys, StructField("features", VectorUDT()), StructField("level_group", StringType())])
    return spark.read.schema(schema).parquet(path)


def filled_rows(vectors: DataFrame, index: DataFrame, fill: float = -1.0) -> DataFrame:
    """The whole feature table in long form, ``session_id, level_group, feature, value``: every kept feature of every session.

    Missing values become ``fill``. ``vectors`` are those of ``with_vectors``.
    """
    named = index.groupBy("level_group").agg(F.array_sort(F.collect_list(F.struct("index", "feature", "zero"))).alias("_names"))
    # One row per group.
    spread = vectors.join(F.broadcast(named), "level_group").withColumn("_dense", vector_to_array("features"))
    rows = spread.select(*KEYS, F.explode(F.arrays_zip("_names", "_dense")).alias("_cell"))
    stored, zero = F.col("_cell._dense"), F.col("_cell._names.zero")
    missing = F.when(zero, stored < 0).otherwise(stored == 0)
    value = F.when(missing, F.lit(float(fill))).when(zero, stored).otherwise(stored - 1)
    return rows.select(*KEYS, F.col("_cell._names.feature").alias("feature"), value.alias("value"))


def to_wide(features: DataFrame, members: DataFrame, names: list[tuple[str, str, bool]], fill: float | None = None) -> DataFrame:
    """One row per session with the named features of one group.

    ``names`` lists (feature, block, zero); the explicit list keeps the pivot to
    one aggregation. Missing counts become 0 for members of their block; with
    ``fill`` every other missing value becomes that number.
    """
    columns = [n for n, _, _ in names]
    if len({safe_name(n) for n in columns}) < len(columns):
        raise ValueError("two names become one column name")
    blocks = sorted({b for _, b, zero in names if zero}) or ["base"]
    wide = features.groupBy("session_id").pivot("feature", columns).agg(F.first("value"))
    inside = members.groupBy("session_id").agg(
        *[F.bool_or(F.col("block") == b).alias(f"_in_{i}") for i, b in enumerate(blocks)]
    )
    wide = inside.join(wide, "session_id", "left")
    out = []
    for name, block, zero in names:
        choices = [f"`{name}`"]
        if zero:
            choices.append(f"case when _in_{blocks.index(block)} then 0D end")
        if fill is not None:
            choices.append(f"{float(fill)}D")
        out.append(f"coalesce({', '.join(choices)}) as `{safe_name(name)}`")
    return wide.selectExpr("session_id", *out)


def safe_name(name: str) -> str:
    """Column name without dots and dashes, for the wide table."""
    return re.sub(r"[^0-9a-zA-Z_]", "_", name)
