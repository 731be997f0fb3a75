"""Sessions above the size limit take another plan; the results must not change."""

import pytest
from pyspark.sql import functions as F

from checks import fixture as fx
from checks.fixture import PARAMS
from sessionweave.operators import cleaning, levels, quantiles, skew, stats
from sessionweave.operators.deltas import event_deltas
from sessionweave.operators.skew import SkewProfile, ntile, split_hot, with_positions
from sessionweave.sources.adapters import events_as_log
from tests.conftest import rows

PLAIN = SkewProfile(total=0, largest=0, limit=10**9)


@pytest.fixture(scope="module")
def events(spark, sf):
    """A third of all rows belong to user 3."""
    events = fx.table(spark, sf, "events")
    hot = F.when(F.col("event_id") % 3 == 0, F.lit(3)).otherwise(F.col("user_id"))
    path = fx.written(spark, "test/hot_events", lambda: events.withColumn("user_id", hot))
    return path


@pytest.fixture(scope="module")
def split(events):
    measured = skew.profile(events, "user_id", rows_per_task=1)
    assert measured.largest * 3 >= measured.total
    return SkewProfile(measured.total, measured.largest, limit=60)


@pytest.fixture(scope="module")
def log(spark, events):
    return fx.written(spark, "test/hot_log", lambda: events_as_log(events, PLAIN))


@pytest.fixture(scope="module")
def with_deltas(spark, log):
    return fx.written(spark, "test/hot_deltas", lambda: event_deltas(log, PLAIN))


def test_profile_bounds_hot_keys(events):
    measured = skew.profile(events, "user_id", rows_per_task=60)
    assert measured.has_hot
    assert skew.hot_keys(events, ["user_id"], measured).count() <= measured.total / measured.limit


def test_chunks_follow_order_and_stay_small(events, split):
    parts = split_hot(events, ["user_id"], "event_id", split)
    hot = parts.where("_hot").groupBy("user_id", "_chunk").agg(
        F.count("*").alias("n"), F.min("event_id").alias("low"), F.max("event_id").alias("high")
    ).orderBy("user_id", "low").collect()
    assert len(hot) > 5
    assert max(r.n for r in hot) <= split.limit
    for a, b in zip(hot, hot[1:]):
        if a.user_id == b.user_id:
            assert a.high < b.low and a._chunk < b._chunk


def test_adapter(events, split):
    assert rows(events_as_log(events, split)) == rows(events_as_log(events, PLAIN))


def test_positions_match_ntile(events, split):
    table = with_positions(events, ["user_id"], "event_id", split)
    got = table.select("event_id", ntile(F.col("_rn"), F.col("_n"), 23).alias("tile"))
    w = skew.Window.partitionBy("user_id").orderBy("event_id")
    want = events.select("event_id", F.ntile(23).over(w).cast("long").alias("tile"))
    assert rows(got) == rows(want)


def test_deltas(log, split):
    assert rows(event_deltas(log, split)) == rows(event_deltas(log, PLAIN))


def test_deltas_do_not_depend_on_row_order(log):
    shuffled = log.orderBy(F.rand(7)).repartition(5)
    assert rows(event_deltas(shuffled, PLAIN)) == rows(event_deltas(log, PLAIN))


@pytest.mark.parametrize("array_rows", [0, 100])
def test_quantiles(with_deltas, split, array_rows):
    """All sessions by counts, or only the hot ones."""
    columns, shares = list(stats.NUMERIC_COLUMNS), (0.1, 0.2, 0.4, 0.6, 0.8, 0.9)
    got = quantiles.nearest_quantiles(with_deltas, stats.KEYS, columns, shares, split, array_rows=array_rows)
    want = quantiles.nearest_quantiles(with_deltas, stats.KEYS, columns, shares, PLAIN)
    assert rows(got) == rows(want)


def test_quantiles_by_value(with_deltas, split):
    table = stats.value_rows(with_deltas, ["event_name"], PARAMS, ["elapsed_time_diff"])
    keys = [*stats.KEYS, "value"]
    args = (table, keys, ["elapsed_time_diff"], (0.2, 0.7, 0.9))
    assert rows(quantiles.nearest_quantiles(*args, split, array_rows=100)) == rows(quantiles.nearest_quantiles(*args, PLAIN))


def test_above_threshold(with_deltas, split):
    got = levels.above_threshold_features(with_deltas, PARAMS, split)
    assert rows(got) == rows(levels.above_threshold_features(with_deltas, PARAMS, PLAIN))


@pytest.mark.parametrize("least", [1, 20, 60])
def test_exclude_short(log, split, least):
    got = cleaning.exclude_short_sessions(log, least, "0-4", split).select("idx")
    assert rows(got) == rows(cleaning.exclude_short_sessions(log, least, "0-4", PLAIN).select("idx"))


def test_exclude_and_restrict(spark, log, split):
    ids = spark.createDataFrame([(3,), (5,), (99999,)], "session_id long")
    for skewed in (split, PLAIN):
        assert cleaning.exclude_sessions(log, ids, skewed).where("session_id in (3, 5)").isEmpty()
        kept = cleaning.restrict_to(log, ids, skewed).select("session_id").distinct()
        assert rows(kept) == [("3",), ("5",)]


def test_ends_of_chunks_are_found_without_sorting(log, split):
    plan = event_deltas(log, split)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "HashAggregate" in plan
