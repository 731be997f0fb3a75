"""Row selection: exclusions, whole-session samples, label ids, level groups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionweave.functions.expressions import hash_int
from sessionweave.workspace import materialised
from sessionweave.operators.skew import SkewProfile, join_sessions


def exclude_listed(rows: DataFrame, ids, column: str = "session_id") -> DataFrame:
    """Drop the sessions of a short literal list."""
    return rows.where(~F.col(column).isin(list(ids)))


def exclude_sessions(log: DataFrame, sessions: DataFrame, skew: SkewProfile) -> DataFrame:
    """Drop the sessions of a table of any size."""
    return join_sessions(log, sessions.select("session_id").distinct(), ["session_id"], "left_anti", skew)


def exclude_short_sessions(log: DataFrame, least: int, group: str, skew: SkewProfile) -> DataFrame:
    """Keep sessions with at least ``least`` events in ``group``."""
    counts = log.where(F.col("level_group") == group).groupBy("session_id").agg(F.count(F.lit(1)).alias("n"))
    kept = counts.where(F.col("n") >= least).select("session_id")
    return join_sessions(log, kept, ["session_id"], "left_semi", skew)


def sample_sessions(log: DataFrame, n: int, seed: int = 42) -> DataFrame:
    """``n`` whole sessions' ids, chosen by a seeded hash of the id."""
    ids = log.select("session_id").distinct()
    order = F.md5(F.concat(F.col("session_id").cast("string"), F.lit(f":{seed}")))
    ids = materialised(ids.select("session_id", order.alias("_o"), F.conv(F.substring(order, 1, 4), 16, 10).cast("int").alias("_b")))
    before, cut = 0, None  # 65,536 prefixes of the hash: the one in which the n-th session lies
    for b, count in sorted(tuple(r) for r in ids.groupBy("_b").count().collect()):
        if before + count >= n:
            cut = b
            break
        before += count
    if cut is None:
        return ids.select("session_id")
    last = ids.where(F.col("_b") == cut).orderBy("_o", "session_id").limit(n - before)
    return ids.where(F.col("_b") < cut).unionByName(last).select("session_id")


def restrict_to(rows: DataFrame, sessions: DataFrame, skew: SkewProfile) -> DataFrame:
    return join_sessions(rows, sessions, ["session_id"], "left_semi", skew)


def split_label_ids(labels: DataFrame, column: str = "label_id") -> DataFrame:
    """``"123_q7"`` gives session 123 and question 7."""
    parts = F.split(column, "_")
    return labels.withColumns(
        {
            "session": F.element_at(parts, 1).cast("long"),
            "q": F.substring(F.element_at(parts, -1), 2, 10).cast("int"),
        }
    )


def assign_folds(sessions: DataFrame, folds: int, seed: int = 42) -> DataFrame:
    """Fold of each session from a seeded hash of its id: the same in every group and run."""
    key = F.concat(F.col("session_id").cast("string"), F.lit(f":{seed}"))
    return sessions.withColumn("fold", F.pmod(hash_int(key), F.lit(folds)).cast("int"))


def noise_features(sessions: DataFrame, n: int = 30, seed: int = 42) -> DataFrame:
    """``n`` whole numbers in [1, 1000) per session as long rows: a floor for feature importance."""
    numbered = sessions.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    key = F.concat_ws(":", F.col("session_id").cast("string"), F.lit(str(seed)), F.col("i").cast("string"))
    return numbered.select(
        *sessions.columns,
        F.concat(F.lit("random"), F.col("i").cast("string")).alias("feature"),
        (F.pmod(hash_int(key), F.lit(999)) + 1).cast("double").alias("value"),
    )
