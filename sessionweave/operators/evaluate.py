"""Macro-F1 over decision thresholds.

Scores are reduced to counts per (question, number of thresholds passed, truth)
before anything else, so the sweep reads the predictions once and never repeats
them per threshold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionweave.presets import THRESHOLD_GRID


def grid(low: int = THRESHOLD_GRID[0], high: int = THRESHOLD_GRID[1]) -> list[float]:
    """Thresholds as exact thousandths."""
    return [i / 1000 for i in range(low, high + 1)]


def confusion(scored: DataFrame, thresholds: list[float]) -> DataFrame:
    """``tp, fp, fn, tn`` per (question, threshold) from rows of ``(q, p, correct)``; positive is ``p > threshold``."""
    thresholds = sorted(thresholds)
    passed = F.expr(" + ".join(f"cast(p > {t!r}D as int)" for t in thresholds))
    counts = scored.select("q", passed.alias("passed"), "correct").groupBy("q", "passed", "correct").agg(
        F.count(F.lit(1)).alias("n")
    )
    steps = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(t).alias("threshold")) for i, t in enumerate(thresholds)])
    each = counts.withColumn("step", F.explode(steps)).withColumn("positive", F.col("passed") > F.col("step.i"))
    true = F.col("correct") == 1

    def total(condition):
        return F.sum(F.when(condition, F.col("n")).otherwise(0))

    return each.groupBy("q", F.col("step.threshold").alias("threshold")).agg(
        total(true & F.col("positive")).alias("tp"),
        total(~true & F.col("positive")).alias("fp"),
        total(true & ~F.col("positive")).alias("fn"),
        total(~true & ~F.col("positive")).alias("tn"),
    )


def overall(counts: DataFrame) -> DataFrame:
    return counts.groupBy("threshold").agg(*[F.sum(c).alias(c) for c in ("tp", "fp", "fn", "tn")])


def with_macro_f1(counts: DataFrame) -> DataFrame:
    """Mean F1 of the classes present in truth or prediction."""

    def f1(hit):
        denominator = 2 * F.col(hit) + F.col("fp") + F.col("fn")
        return F.when(denominator > 0, 2 * F.col(hit) / denominator)

    one, zero = f1("tp"), f1("tn")
    classes = one.isNotNull().cast("int") + zero.isNotNull().cast("int")
    return counts.withColumn(
        "macro_f1", (F.coalesce(one, F.lit(0.0)) + F.coalesce(zero, F.lit(0.0))) / F.nullif(classes, F.lit(0))
    )


def threshold_sweep(scored: DataFrame, thresholds: list[float] | None = None) -> DataFrame:
    return with_macro_f1(overall(confusion(scored, thresholds or grid())))


def best_threshold(sweep: DataFrame) -> DataFrame:
    """The best row; the smallest threshold wins a tie."""
    return sweep.orderBy(F.desc("macro_f1"), "threshold").limit(1)


def macro_f1_by_question(scored: DataFrame, thresholds: list[float] | None = None) -> DataFrame:
    """Each question's score at the overall best threshold.

    """
    counts = confusion(scored, thresholds or grid())
    best = best_threshold(with_macro_f1(overall(counts))).select("threshold")
    return with_macro_f1(counts.join(F.broadcast(best), "threshold"))


def truth_matrix(labels: DataFrame, questions) -> DataFrame:
    wide = labels.groupBy("session_id").pivot("q", list(questions)).agg(F.max("correct"))
    return wide.select("session_id", *[F.col(str(q)).alias(f"q{q}") for q in questions])
