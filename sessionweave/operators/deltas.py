"""Row deltas: gaps to the previous and next event, cursor moves, sentinels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionweave.operators.skew import SkewProfile, profile, with_neighbours
from sessionweave.presets import FQID_NONE, TEXT_FQID_NONE

GAP_MAX = 1_000_000_000


def clip_gap(gap: Column) -> Column:
    """Missing or negative gaps are 0; very long ones are capped."""
    return F.least(F.greatest(F.coalesce(gap, F.lit(0)), F.lit(0)), F.lit(GAP_MAX)).cast("long")


def fill_sentinels(log: DataFrame) -> DataFrame:
    return log.withColumns(
        {
            "fqid": F.coalesce("fqid", F.lit(FQID_NONE)),
            "text_fqid": F.coalesce("text_fqid", F.lit(TEXT_FQID_NONE)),
        }
    )


def event_deltas(log: DataFrame, skew: SkewProfile | None = None) -> DataFrame:
    """Add the four deltas within (session, level group), ordered by ``idx``."""
    skew = skew or profile(log)
    columns = ["elapsed_time", "screen_coor_x", "screen_coor_y"]
    rows = with_neighbours(log, ["session_id", "level_group"], "idx", columns, skew, ["session_id"])
    return fill_sentinels(rows).withColumns(
        {
            "page": F.col("page").cast("double"),
            "elapsed_time_diff": clip_gap(F.col("elapsed_time") - F.col("_prev.elapsed_time")),
            "elapsed_time_diff_to": clip_gap(F.col("_next.elapsed_time") - F.col("elapsed_time")),
            "location_x_diff": F.abs(F.col("screen_coor_x") - F.col("_prev.screen_coor_x")),
            "location_y_diff": F.abs(F.col("screen_coor_y") - F.col("_prev.screen_coor_y")),
        }
    ).drop("_prev", "_next")


def gap_flags(log: DataFrame, cuts) -> DataFrame:
    """One 0/1 column per cut: is the gap at least that long."""
    return log.withColumns(
        {f"elapsed_time_over{n}": F.when(F.col("elapsed_time_diff") >= n, 1).otherwise(0) for n in cuts}
    )


def cap_gap(log: DataFrame, cap: int) -> DataFrame:
    """Winsorise the gap; a missing gap stays missing."""
    gap = F.col("elapsed_time_diff")
    return log.withColumn("elapsed_time_diff", F.when(gap >= cap, F.lit(cap).cast("long")).otherwise(gap))
