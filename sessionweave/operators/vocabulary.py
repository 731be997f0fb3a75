"""Fitted vocabularies: the values of a dimension that enough sessions have.

The table is fitted on the training log, saved with it and joined when another log
is scored, so that rare values add no feature names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VALUE = ["level_group", "dimension", "value"]


def fit_vocabulary(cells: DataFrame, sessions: DataFrame, support: dict[str, float]) -> DataFrame:
    """``level_group, dimension, value, support`` of the values seen in a share of the group's sessions.

    ``cells`` has one row per (session, group, dimension, value), ``support`` the least share of
    each fitted dimension, ``sessions`` the sessions of each group. At least one session is asked for.
    """
    share = F.coalesce(*[F.when(F.col("dimension") == d, F.lit(float(s))) for d, s in support.items()], F.lit(None).cast("double"))
    # The product is rounded first: a share such as 1 - 0.97 is not an exact 0.03.
    least = F.greatest(F.floor(F.round(F.col("sessions") * share, 9)), F.lit(1))
    counted = cells.where(F.col("dimension").isin(list(support))).groupBy(*VALUE).agg(F.count(F.lit(1)).alias("support"))
    # One row per group.
    return counted.join(F.broadcast(sessions), "level_group").where(F.col("support") >= least).drop("sessions")


def keep_vocabulary(table: DataFrame, vocabulary: DataFrame, dimensions) -> DataFrame:
    """Rows of ``table`` whose value is in the vocabulary, and all rows of dimensions that are not fitted."""
    listed = vocabulary.select(*VALUE, F.lit(True).alias("_listed"))
    known = table.join(listed, VALUE, "left")
    return known.where(~F.col("dimension").isin(list(dimensions)) | F.col("_listed")).drop("_listed")
