"""The driver's tables as inputs of the library: event log, answers, parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionweave.operators.deltas import event_deltas
from sessionweave.operators.skew import SkewProfile, profile
from sessionweave.plans.features import log_bucket
from sessionweave.workspace import remembered, written
from sessionweave.presets import FeatureParams, Milestone, Transition
from sessionweave.sources.adapters import answers_for_sessions, events_as_log


def _is(column, value):
    return ((column, value),)


PARAMS = FeatureParams(
    version=4,
    vocabularies={},
    words=("that", "this", "it", "you", "can", "is", "do"),
    gap_flags=(1000000, 5000000, 10000000, 50000000, 100000000, 200000000),
    gap_cap=50000000,
    group_add_on={"0-4": 20000000, "5-12": 20000000, "13-22": 20000000},
    milestones=(
        Milestone("0-4", "both_texts", (_is("text", "text this is it"), _is("text", "text you can do that"))),
        Milestone("0-4", "click_fq1", ((("event_name", "click"), ("fqid", "fq1")), _is("fqid", "fq2"))),
        Milestone("5-12", "fq3_fq4", (_is("fqid", "fq3"), _is("fqid", "fq4")), "fq3_to_fq4"),
        Milestone("13-22", "tx1_fq5", (_is("text_fqid", "tx.1"), _is("fqid", "fq5"))),
    ),
    transitions=(
        Transition("0-4", "to_tx2", (_is("fqid", "fq1"),), (_is("text_fqid", "tx.2"),)),
        Transition("5-12", "found_tx5", (_is("text_fqid", "tx.4"),), (_is("text_fqid", "tx.5"),)),
    ),
    support=0.1,
    text_support=0.3,
    event_level_events=("view", "click", "purchase"),
    pair_events=("click", "view"),
    navigate_event="click",
    popularity_cuts=(3, 7, 11, 16),
    grid_rooms={"0-4": ("room.0", "room.1"), "5-12": ("room.0", "room.1", "room.2"), "13-22": ("room.0", "room.3")},
)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def skew(spark: SparkSession, sf: str) -> SkewProfile:
    return remembered(spark, f"{sf}/skew", lambda: profile(table(spark, sf, "events"), "user_id"))


def raw_log(spark: SparkSession, sf: str) -> DataFrame:
    """Event log before any derivation, written once."""
    build = lambda: events_as_log(table(spark, sf, "events"), skew(spark, sf))
    return written(spark, f"{sf}/raw_log", build, ("level_group",))


def log(spark: SparkSession, sf: str) -> DataFrame:
    """Event log with deltas and sentinels, written once and bucketed by session."""
    build = lambda: event_deltas(raw_log(spark, sf), skew(spark, sf))
    return written(spark, f"{sf}/log", build, ("level_group",), log_bucket(skew(spark, sf)))


def sessions(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(F.col("user_id").alias("session_id")).distinct()


def answers(spark: SparkSession, sf: str) -> DataFrame:
    return answers_for_sessions(sessions(spark, sf))
