"""Clicks: repeats on one point, popularity of room cells, room grids."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sessionweave.functions.expressions import grid_bin, popularity_category
from sessionweave.operators.stats import KEYS
from sessionweave.presets import FQID_NONE, FeatureParams

CELL = ["level_group", "room_fqid", "room_x", "room_y"]


def repeat_clicks(log: DataFrame, params: FeatureParams) -> DataFrame:
    """Most clicks on one point, and points clicked at least ``repeat_min`` times (null if none)."""
    points = (
        log.where("screen_coor_x is not null")
        .groupBy(*KEYS, "screen_coor_x", "screen_coor_y")
        .agg(F.count(F.lit(1)).alias("clicks"))
    )
    often = F.count_if(F.col("clicks") >= params.repeat_min)
    return points.groupBy(*KEYS).agg(
        F.max("clicks").alias("click_same_max"), F.nullif(often, F.lit(0)).alias("click_same_over")
    )


def navigate_cells(log: DataFrame, params: FeatureParams, size: int | None = None) -> DataFrame:
    """Clicks on empty ground per (session, room cell)."""
    size = size or params.cell_size
    return (
        log.where((F.col("event_name") == params.navigate_event) & (F.col("fqid") == FQID_NONE))
        .groupBy(
            *KEYS,
            "room_fqid",
            grid_bin(F.col("room_coor_x"), size).alias("room_x"),
            grid_bin(F.col("room_coor_y"), size).alias("room_y"),
        )
        .agg(F.count("idx").alias("n"))
    )


def cell_popularity(cells: DataFrame, params: FeatureParams) -> DataFrame:
    """``fit`` step: sessions and category of each cell, per level group."""
    return (
        cells.groupBy(*CELL)
        .agg(F.count(F.lit(1)).alias("sessions"))
        .withColumn("category", popularity_category(F.col("sessions"), params.popularity_cuts))
    )


def navigate_category_counts(cells: DataFrame, popularity: DataFrame, params: FeatureParams) -> DataFrame:
    """Clicks per (session, room, category); a cell without an entry is category 1.

    A cell with a missing coordinate equals no entry, as in any SQL join.
    """
    joined = cells.join(popularity.select(*CELL, "category"), CELL, "left")
    rooms = params.vocabularies.get("room_fqid")
    if rooms:
        joined = joined.where(F.col("room_fqid").isin(list(rooms)))
    return joined.groupBy(*KEYS, "room_fqid", F.coalesce("category", F.lit(1)).alias("category")).agg(
        F.sum("n").alias("n")
    )


# --- room grids -------------------------------------------------------------


def room_grid_cells(log: DataFrame, params: FeatureParams) -> DataFrame:
    """Clicks per (session, cell) of the rooms listed for each group; zeros are implicit."""
    listed = F.lit(False)
    for group, rooms in params.grid_rooms.items():
        listed = listed | ((F.col("level_group") == group) & F.col("room_fqid").isin(list(rooms)))
    located = F.col("room_coor_x").isNotNull() & F.col("room_coor_y").isNotNull()
    return navigate_cells(log.where(listed & located), params, params.grid_size)


def clip_cells(cells: DataFrame, params: FeatureParams) -> DataFrame:
    return cells.withColumn("n", F.least("n", F.lit(params.grid_clip)))


def room_grid_axes(cells: DataFrame) -> DataFrame:
    """Distinct bins of each (group, room) axis, numbered from 0."""
    bins = cells.unpivot(["level_group", "room_fqid"], ["room_x", "room_y"], "axis", "bin").distinct()
    axis = Window.partitionBy("level_group", "room_fqid", "axis")
    return bins.select(
        "*",
        (F.row_number().over(axis.orderBy("bin")) - 1).alias("position"),
        F.count(F.lit(1)).over(axis).alias("length"),
    )


def with_slots(cells: DataFrame, axes: DataFrame) -> DataFrame:
    """Number each cell within its room's full grid (every x with every y bin).

    ``slot`` and ``grid_size`` address cells nobody clicked as well, without a row
    for each of them.
    """
    x = axes.where("axis = 'room_x'").select(
        "level_group", "room_fqid", F.col("bin").alias("room_x"), F.col("position").alias("_x"), F.col("length").alias("_nx")
    )
    y = axes.where("axis = 'room_y'").select(
        "level_group", "room_fqid", F.col("bin").alias("room_y"), F.col("position").alias("_y"), F.col("length").alias("_ny")
    )
    return (
        cells.join(x, ["level_group", "room_fqid", "room_x"])
        .join(y, ["level_group", "room_fqid", "room_y"])
        .withColumn("slot", F.col("_x") * F.col("_ny") + F.col("_y"))
        .withColumn("grid_size", F.col("_nx") * F.col("_ny"))
        .drop("_x", "_y", "_nx", "_ny")
    )


def one_hot_cells(cells: DataFrame) -> DataFrame:
    """One-hot view of a session's clicks in a room: the bins hit on each axis with their clicks."""
    marks = cells.unpivot([*KEYS, "room_fqid", "n"], ["room_x", "room_y"], "axis", "bin")
    return marks.groupBy(*KEYS, "room_fqid", "axis", "bin").agg(F.sum("n").alias("n"))


def room_grid_scale(clipped: DataFrame) -> DataFrame:
    """``fit`` step of the scaler: mean and population deviation per cell over the room's sessions.

    Sums come from the clicked cells only; sessions that never clicked a cell add
    zeros, which count in the divisor alone. A constant cell has scale 1.
    """
    rooms = clipped.select("level_group", "room_fqid", "session_id").distinct()
    rooms = rooms.groupBy("level_group", "room_fqid").agg(F.count(F.lit(1)).alias("sessions"))
    sums = clipped.groupBy(*CELL).agg(F.sum("n").alias("total"), F.sum(F.col("n") * F.col("n")).alias("squares"))
    mean = F.col("total") / F.col("sessions")
    # Integer arithmetic up to the root, so that a constant cell gives exactly 0.
    spread = F.sqrt((F.col("sessions") * F.col("squares") - F.col("total") * F.col("total")).cast("double"))
    return sums.join(rooms, ["level_group", "room_fqid"]).select(
        *CELL,
        "sessions",
        mean.alias("mean"),
        F.when(spread > 0, spread / F.col("sessions")).otherwise(F.lit(1.0)).alias("scale"),
    )


def room_grid_scaled(clipped: DataFrame, scale: DataFrame) -> DataFrame:
    """Scaled value of each clicked cell; an unclicked cell is ``-mean / scale``."""
    return clipped.join(scale, CELL).select(
        *KEYS, "room_fqid", "room_x", "room_y", ((F.col("n") - F.col("mean")) / F.col("scale")).alias("scaled")
    )
