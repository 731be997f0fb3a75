"""Hand-made frames: single rows, ties, nulls, empty groups."""

import pytest
from pyspark.sql import functions as F

from sessionweave.functions.expressions import popularity_category, time_parts, year_weight
from sessionweave.operators import chain, cleaning, clicks, combos, deltas, evaluate, levels, longtable, quantiles, stats
from sessionweave.operators.skew import SkewProfile
from sessionweave.presets import FeatureParams

PLAIN = SkewProfile(0, 0, 10**9)
SCHEMA = """session_id long, idx long, elapsed_time long, level int, level_group string, event_name string, name string,
page double, room_coor_x double, room_coor_y double, screen_coor_x double, screen_coor_y double, hover_duration double,
text string, fqid string, room_fqid string, text_fqid string"""


def event(session=1, idx=0, time=0, level=0, group="0-4", event_name="navigate_click", name="basic", page=None, rx=None, ry=None,
          sx=None, sy=None, hover=None, text=None, fqid=None, room="r", text_fqid=None):
    return (session, idx, time, level, group, event_name, name, page, rx, ry, sx, sy, hover, text, fqid, room, text_fqid)


def make(spark, *events):
    return deltas.event_deltas(spark.createDataFrame(list(events), SCHEMA), PLAIN)


def test_single_event_session(spark):
    row = make(spark, event(time=5)).first()
    assert (row.elapsed_time_diff, row.elapsed_time_diff_to) == (0, 0)
    assert row.location_x_diff is None
    assert (row.fqid, row.text_fqid) == ("fqid_None", "text_fqid_None")


def test_gaps_stay_inside_group_and_are_clipped(spark):
    log = make(
        spark,
        event(idx=0, time=0, sx=1.0),
        event(idx=1, time=2 * 10**9, sx=None),
        event(idx=2, time=100, sx=4.0),
        event(idx=3, time=200, level=5, group="5-12", sx=9.0),
    ).orderBy("idx").collect()
    assert [r.elapsed_time_diff for r in log] == [0, 10**9, 0, 0]
    assert [r.elapsed_time_diff_to for r in log] == [10**9, 0, 0, 0]
    assert [r.location_x_diff for r in log] == [None, None, None, None]


def test_flags_before_cap(spark):
    log = make(spark, event(idx=0, time=0), event(idx=1, time=30000), event(idx=2, time=49999))
    row = deltas.cap_gap(deltas.gap_flags(log, (20000, 50000)), 20000).where("idx = 1").first()
    assert (row.elapsed_time_over20000, row.elapsed_time_over50000, row.elapsed_time_diff) == (1, 0, 20000)


def test_distincts_count_the_sentinel_but_not_nulls(spark):
    log = make(spark, event(idx=0, fqid="a", name=None), event(idx=1, fqid=None, name=None))
    row = stats.session_distincts(log).first()
    assert (row.fqid_unique, row.name_unique) == (2, 0)


@pytest.mark.parametrize("n", range(1, 12))
def test_nearest_quantile_ranks(spark, n):
    df = spark.createDataFrame([(1, float(i)) for i in range(n)] + [(1, None)], "session_id long, x double")
    row = quantiles.nearest_quantiles(df, ["session_id"], ["x"], (0.1, 0.5, 0.9), PLAIN).first()
    assert list(row)[1:] == [float(int((n - 1) * q + 0.5)) for q in (0.1, 0.5, 0.9)]


def test_quantiles_of_nothing_are_null(spark):
    df = spark.createDataFrame([(1, None)], "session_id long, x double")
    assert quantiles.nearest_quantiles(df, ["session_id"], ["x"], (0.5,), PLAIN).first().x_quantile5 is None


def test_level_features_keep_missing_levels_null(spark):
    log = make(
        spark, event(idx=0, time=0, level=0), event(idx=1, time=10, level=0), event(idx=2, time=5, level=1), event(idx=3, time=50, level=4)
    )
    row = levels.level_time_features(log, FeatureParams()).first()
    assert row["elapsed_time_total_level_0"] == 10
    assert row["elapsed_time_level_diff_fixed_0"] == -5
    assert row["elapsed_time_level_diff_fixed_1"] == 0
    assert row["elapsed_time_level_diff_fixed_2"] is None
    assert row["elapsed_time_max0-4"] == 50 and row["elapsed_time_max5-12"] is None
    assert row["elapsed_time_diff_fixed_max0_3_min4"] == 0
    assert row["elapsed_time_diff_fixed_max5-11_min12"] is None


def test_threshold_needs_the_last_level(spark):
    params = FeatureParams(group_add_on={"0-4": 10})
    log = make(
        spark,
        event(1, 0, 0, 0), event(1, 1, 100, 4), event(1, 2, 110, 4), event(1, 3, 111, 4),
        event(2, 0, 0, 0), event(2, 1, 10**6, 3),
    )
    assert [tuple(r) for r in levels.session_thresholds(log, params).collect()] == [(1, "0-4", 110)]
    above = levels.above_threshold_rows(log, params, PLAIN).collect()
    assert [(r.session_id, r.idx) for r in above] == [(1, 3)]


def test_milestones_zero_and_transitions_null(spark):
    log = make(spark, event(idx=0, time=3, text="Found it!"), event(idx=4, time=9, text="Found it!"))
    spans = stats.milestone_features(log, FeatureParams()).first()
    assert (spans.notebook_found_duration, spans.notebook_found_indexCount) == (6, 4)
    assert spans.shirt_watch_duration == 0
    assert spans.logbook_bingo_duration is None
    assert stats.milestone_transitions(log, FeatureParams()).first().to_shirt_et is None


def test_transition_may_be_negative(spark):
    log = make(
        spark,
        event(idx=0, time=5, text_fqid="tunic.historicalsociety.collection.cs"),
        event(idx=1, time=9, text="Hey Jo, let's take a look at the shirt!"),
    )
    row = stats.milestone_transitions(log, FeatureParams()).first()
    assert (row.to_shirt_et, row.to_shirt_id) == (-4, -1)


def test_words_match_inside_words(spark):
    log = make(spark, event(idx=0, text="with this"), event(idx=1, text=None))
    found = {r.value: r.n for r in stats.word_features(log, FeatureParams()).collect()}
    assert found["it"] == 1 and found["this"] == 1 and found["is"] == 1 and "flag" not in found


def test_combo_mining_drops_lonely_first_values(spark):
    log = make(
        spark,
        event(1, 0, fqid="a", level=0), event(1, 1, fqid="a", level=1), event(1, 2, fqid="b", level=1),
        event(2, 0, fqid="a", level=0), event(2, 1, fqid="a", level=1), event(2, 2, fqid="b", level=1),
    )
    mined = combos.frequent_fqid_level_room(log, FeatureParams(support=1.0))
    assert sorted((r.fqid, r.level) for r in mined.collect()) == [("a", 0), ("a", 1)]


def test_repeat_clicks(spark):
    five = [event(1, i, sx=1.0, sy=None) for i in range(5)]
    row = {r.session_id: r for r in clicks.repeat_clicks(make(spark, *five, event(2, 0, sx=1.0, sy=1.0), event(3, 0)), FeatureParams()).collect()}
    assert (row[1].click_same_max, row[1].click_same_over) == (5, 1)
    assert (row[2].click_same_max, row[2].click_same_over) == (1, None)
    assert 3 not in row


def test_popularity_edges(spark):
    df = spark.createDataFrame([(n,) for n in (400, 401, 1500, 4000, 4001, 9999, 10000)], "n int")
    got = [r.c for r in df.select(popularity_category(F.col("n"), (400, 1500, 4000, 10000)).alias("c")).collect()]
    assert got == [1, 2, 2, 3, 4, 4, 5]


def test_cell_without_coordinates_is_category_one(spark):
    params = FeatureParams(vocabularies={}, popularity_cuts=(0, 1, 2, 3))
    log = make(spark, event(1, 0), event(1, 1, rx=-1.0, ry=5.0), event(1, 2, rx=-1.0, ry=5.0))
    cells = clicks.navigate_cells(log, params)
    got = {r.category: r.n for r in clicks.navigate_category_counts(cells, clicks.cell_popularity(cells, params), params).collect()}
    assert got == {1: 1, 2: 2}


def test_grid_scale_of_constant_and_sparse_cells(spark):
    params = FeatureParams(grid_rooms={"0-4": ("r",)})
    log = make(spark, event(1, 0, rx=0.0, ry=0.0), event(2, 0, rx=0.0, ry=0.0), *[event(2, i, rx=200.0, ry=0.0) for i in range(1, 6)])
    scale = {r.room_x: r for r in clicks.room_grid_scale(clicks.clip_cells(clicks.room_grid_cells(log, params), params)).collect()}
    assert (scale[0].mean, scale[0].scale) == (1.0, 1.0)
    assert (scale[1].mean, scale[1].scale) == (1.5, 1.5)


# --- long table ------------------------------------------------------------------


def long_rows(spark, cells, members):
    rows = spark.createDataFrame(
        [(s, "0-4", b, f, z, float(v)) for s, b, f, z, v in cells],
        "session_id long, level_group string, block string, feature string, zero boolean, value double",
    )
    inside = spark.createDataFrame([(s, "0-4", b) for s, b in members], "session_id long, level_group string, block string")
    return rows, inside


def test_prune_rates_and_constants(spark):
    everyone = [(s, "base") for s in range(1000)]
    cells = [(s, "base", "rare", False, s) for s in range(25)]
    cells += [(s, "base", "rare_above", False, s) for s in range(25)]
    cells += [(s, "base", "rarest_above", False, s) for s in range(2)]
    cells += [(s, "base", "constant", False, 7) for s in range(1000)]
    cells += [(s, "base", "constant_or_null", False, 7) for s in range(500)]
    cells += [(s, "base", "counted", True, 1) for s in range(5)]
    cells += [(s, "late", "late_count", True, 1) for s in range(40)]
    rows, inside = long_rows(spark, cells, everyone + [(s, "late") for s in range(40)])
    kept = {r.feature for r in longtable.prune(longtable.feature_summary(rows, inside)).collect()}
    assert kept == {"rare_above", "constant_or_null", "counted", "late_count"}


def test_listed_counts_without_rows(spark):
    """A count nobody has is 0 or null by membership: kept in a partial block, constant in none."""
    rows, inside = long_rows(spark, [(s, "base", "m", False, s) for s in range(10)], [(s, "base") for s in range(10)] + [(1, "above"), (2, "above")])
    names = longtable.listed_counts(spark, FeatureParams(levels=(0,), vocabularies={}))
    assert {r.feature for r in names.collect()} == {"index_count_0_grp0-4_above", "index_count_0_grp5-12_above"}
    summary = longtable.feature_summary(rows, inside, names)
    row = summary.where("block = 'above'").first()
    assert (row.feature, row.sessions, row.present, row.low, row.high) == ("index_count_0_grp0-4_above", 10, 2, 0.0, 0.0)
    assert {r.feature for r in longtable.prune(summary).collect()} == {"m", "index_count_0_grp0-4_above"}
    wide = longtable.to_wide(rows, inside, [("index_count_0_grp0-4_above", "above", True)]).collect()
    assert {r.session_id: r.index_count_0_grp0_4_above for r in wide if r.session_id < 4} == {0: None, 1: 0.0, 2: 0.0, 3: None}


def test_wide_fill_rules(spark):
    rows, inside = long_rows(spark, [(1, "base", "a.b", True, 2), (2, "late", "c", True, 3), (1, "base", "m", False, 4)],
                             [(1, "base"), (2, "base"), (3, "base"), (2, "late"), (3, "late")])
    names = [("a.b", "base", True), ("c", "late", True), ("m", "base", False)]
    wide = {r.session_id: (r.a_b, r.c, r.m) for r in longtable.to_wide(rows, inside, names).collect()}
    assert wide == {1: (2.0, None, 4.0), 2: (0.0, 3.0, None), 3: (0.0, 0.0, None)}
    filled = {r.session_id: (r.a_b, r.c, r.m) for r in longtable.to_wide(rows, inside, names, -1).collect()}
    assert filled == {1: (2.0, -1.0, 4.0), 2: (0.0, 3.0, -1.0), 3: (0.0, 0.0, -1.0)}


def test_merge_reaches_the_last_group_through_the_middle_one(spark):
    rows = spark.createDataFrame(
        [(1, "0-4", "base", "f", False, 1.0), (2, "0-4", "base", "f", False, 2.0), (1, "5-12", "base", "g", False, 3.0)],
        "session_id long, level_group string, block string, feature string, zero boolean, value double",
    )
    inside = spark.createDataFrame(
        [(1, "0-4", "base"), (2, "0-4", "base"), (1, "5-12", "base"), (1, "13-22", "base"), (2, "13-22", "base")],
        "session_id long, level_group string, block string",
    )
    merged, members = longtable.merge_groups(rows, inside, ("0-4", "5-12", "13-22"))
    last = merged.where("level_group = '13-22'")
    assert sorted((r.session_id, r.feature) for r in last.collect()) == [(1, "f"), (1, "g")]
    assert members.where("level_group = '13-22' and block = 'base@0-4'").count() == 1


def test_time_parts(spark):
    df = spark.createDataFrame([(20090312431273200,)], "session_id long")
    row = df.select(*[c.alias(n) for n, c in time_parts(F.col("session_id")).items()]).first()
    assert tuple(row) == (20, 10, 3, 12, 43, 12)
    members = spark.createDataFrame([(20090312431273200, "0-4", "base")], "session_id long, level_group string, block string")
    assert {r.feature for r in longtable.time_rows(members, 2).collect()} == {"year", "month"}
    assert "year" not in {r.feature for r in longtable.time_rows(members, 8).collect()}
    assert longtable.time_rows(members, 0).isEmpty()
    weights = df.select(year_weight(F.col("session_id"), (2.0, 3.0, 4.0)).alias("w")).first()
    assert weights.w == 2.0


# --- labels and evaluation ---------------------------------------------------------


def test_label_ids_and_missing_labels(spark):
    labels = spark.createDataFrame([("20090312431273200_q18", 1), ("5_q1", 0)], "session_id string, correct int")
    got = {(r.session, r.q) for r in cleaning.split_label_ids(labels, "session_id").collect()}
    assert got == {(20090312431273200, 18), (5, 1)}
    sessions = spark.createDataFrame([(5,), (6,)], "session_id long")
    known = spark.createDataFrame([(5, 1, 0)], "session_id long, q int, correct int")
    with pytest.raises(chain.MissingLabels):
        chain.require_labels(sessions, known, 1)


def test_macro_f1(spark):
    scored = spark.createDataFrame([(1, 0.62, 1), (1, 0.61, 0), (1, 0.7, 1), (1, 0.1, 1)], "q int, p double, correct int")
    row = evaluate.threshold_sweep(scored, [0.62]).first()
    assert (row.tp, row.fp, row.fn, row.tn) == (1, 0, 2, 1)
    assert row.macro_f1 == pytest.approx((2 / 4 + 2 / 4) / 2)
    best = evaluate.best_threshold(evaluate.threshold_sweep(scored)).first()
    assert best.threshold == 0.61


def test_macro_f1_of_one_class(spark):
    scored = spark.createDataFrame([(1, 0.9, 1), (1, 0.8, 1)], "q int, p double, correct int")
    assert evaluate.threshold_sweep(scored, [0.62]).first().macro_f1 == 1.0


def test_best_threshold_tie_takes_the_smallest(spark):
    scored = spark.createDataFrame([(1, 0.9, 1), (1, 0.1, 0)], "q int, p double, correct int")
    assert evaluate.best_threshold(evaluate.threshold_sweep(scored)).first().threshold == 0.6
    assert len(evaluate.grid()) == 51
