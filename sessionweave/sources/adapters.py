"""Turn a plain events table into the event-log layout the operators read."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionweave.operators.skew import SkewProfile, ntile, profile, with_positions


def rename_roles(df: DataFrame, roles: dict[str, str]) -> DataFrame:
    """Rename source columns to their roles: ``{"user_id": "session_id", ...}``."""
    return df.withColumnsRenamed(roles)


def events_as_log(events: DataFrame, skew: SkewProfile | None = None, buckets: int = 23) -> DataFrame:
    """Event log from ``(event_id, ts, user_id, event_type, value, props)``.

    A user is a session, levels are equal shares of its events in order, and the
    attributes come from the ``k`` property. All three level groups occur.
    """
    skew = skew or profile(events, "user_id")
    base = (
        with_positions(events, ["user_id"], "event_id", skew, {"_t0": F.min("ts")})
        .select(
            F.col("user_id").alias("session_id"),
            F.col("event_id").alias("idx"),
            F.col("event_type").alias("event_name"),
            "value",
            F.get_json_object("props", "$.k").cast("int").alias("k"),
            F.expr("timestampdiff(MILLISECOND, _t0, ts)").alias("elapsed_time"),
            (ntile(F.col("_rn"), F.col("_n"), buckets) - 1).cast("int").alias("level"),
        )
    )
    k, value = F.col("k"), F.col("value")
    located = k % 11 != 0
    name = F.element_at(F.array(*map(F.lit, ("basic", "undefined", "close", "open", "prev", "next"))), k % 6 + 1)
    return base.select(
        "session_id",
        "idx",
        "elapsed_time",
        "level",
        F.when(F.col("level") <= 4, "0-4").when(F.col("level") <= 12, "5-12").otherwise("13-22").alias("level_group"),
        "event_name",
        name.alias("name"),
        F.when(k % 7 < 3, (k % 7).cast("double")).alias("page"),
        F.when(located, value * 4 - 500).alias("room_coor_x"),
        F.when(located, (k * 9 - 400).cast("double")).alias("room_coor_y"),
        F.when(located, (F.floor(value / 50) * 50).cast("double")).alias("screen_coor_x"),
        F.when(located, ((k % 4) * 100).cast("double")).alias("screen_coor_y"),
        F.when(F.col("event_name") == "view", value).alias("hover_duration"),
        F.when(
            k % 5 != 0, F.concat(F.lit("text "), F.when(k % 2 == 0, "this is it").otherwise("you can do that"))
        ).alias("text"),
        F.when(k % 4 != 0, F.concat(F.lit("fq"), (k % 9).cast("string"))).alias("fqid"),
        F.concat(F.lit("room."), (k % 4).cast("string")).alias("room_fqid"),
        F.when(k % 3 != 0, F.concat(F.lit("tx."), (k % 8).cast("string"))).alias("text_fqid"),
    )


def answers_for_sessions(sessions: DataFrame, questions: range = range(1, 19)) -> DataFrame:
    """Deterministic answers and scores for each session and question.

    One row per (session, question) made by exploding a short list, in the label
    file's layout (``"<session>_q<q>"``) plus a score in thousandths.
    """
    asked = sessions.select("session_id", F.explode(F.array(*map(F.lit, questions))).alias("q"))
    s, q = F.col("session_id"), F.col("q")
    return asked.select(
        "session_id",
        "q",
        F.concat(s.cast("string"), F.lit("_q"), q.cast("string")).alias("label_id"),
        F.when((s * 7 + q * 13) % 10 < 6, 1).otherwise(0).alias("correct"),
        ((s * 31 + q * 17) % 1000).cast("int").alias("p1000"),
        (((s * 31 + q * 17) % 1000) / 1000.0).cast("double").alias("p"),
    )
