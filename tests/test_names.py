from collections import Counter
from dataclasses import replace

from checks import fixture as fx
from checks.fixture import PARAMS
from sessionweave.operators import names
from sessionweave.plans.features import session_features
from sessionweave.presets import FeatureParams


def test_counts_of_names_by_operator(spark):
    """Columns of one group with every option, and no name twice."""
    table = [tuple(r) for r in names.feature_names(spark, FeatureParams(version=4)).collect()]
    for group, spans in (("0-4", 4 + 2), ("5-12", 12 + 2), ("13-22", 18)):
        own = [r for r in table if r[0] == group]
        by = Counter(r[2] for r in own)
        main = ("session_counts", "session_distincts", "numeric_quantiles", "numeric_stats", "by_event_name_quantiles")
        assert sum(n for op, n in by.items() if op in main or (op.startswith("by_") and op not in ("by_text_quantiles", "by_room_quantiles"))) == 2057
        assert (by["by_event_name"] + by["by_event_name_quantiles"], by["by_name"], by["by_room_fqid"], by["by_fqid"], by["by_text_fqid"]) == (121 + 44, 30, 114, 762, 756)
        assert by["level_times"] == 49 and by["above_threshold"] == (0 if group == "13-22" else 106)
        assert (by["event_level_counts"], by["event_name_pair_counts"], by["repeat_clicks"], by["gap_flags"], by["navigate_category_counts"]) == (115, 12, 2, 6, 95)
        assert by["by_text_quantiles"] + by["by_room_quantiles"] == 435
        assert by["milestones"] + by["transitions"] == spans
    assert len({r[1] for r in table}) == len(table)


def test_names_resolve_both_ways(spark):
    asked = [
        ("worker_ET_mean_grp0-4", "worker_ET_mean_grp0-4", "0-4", "by_fqid", "worker", "et_mean"),
        ("word_it_grp5-12", "word_it_grp5-12", "5-12", "by_word", "it", "n"),
        ("map_click_3_ET_min_grp0-4", "map_click_3_count_grp0-4", "0-4", "event_level_counts", "map_click_3", "n"),
        ("index_count_7_grp0-4_above", "index_count_7_grp0-4_above", "0-4", "above_threshold", "7", "n"),
        ("tobasement_tunic.historicalsociety.stacks_3_countsgrp0-4", None, "0-4", "combo_features", "tobasement_tunic.historicalsociety.stacks_3", "n"),
        ("tunic.historicalsociety.closet.intro_0_ET_sum_grp0-4", None, "0-4", "combo_features", "tunic.historicalsociety.closet.intro_0", "et_sum"),
        ("tunic.historicalsociety.closet.intro_0ET_count_grp0-4", None, None, None, None, None),
        ("to_shirt_et", "to_shirt_et", "0-4", "transitions", "to_shirt", "et"),
        ("l18_hoofprint_bingo_duration", "l18_hoofprint_bingo_duration", "13-22", "milestones", "l18_hoofprint_bingo", "duration"),
        ("random17", "random17", None, "noise_features", None, None),
        ("year", "year", None, "time_parts", "year", None),
        ("no_such_name", "no_such_name", None, None, None, None),
    ]
    df = spark.createDataFrame([(a[0],) for a in asked], "feature string")
    got = {r.feature: tuple(r) for r in names.resolve_names(df, FeatureParams(version=4)).collect()}
    for a in asked:
        if a[0].startswith("tunic") and "ET_count" in a[0]:
            assert got[a[0]][3] == "combo_features" and got[a[0]][5] == "n"
        else:
            assert got[a[0]] == (a[0], a[1] or a[0], *a[2:])


def test_every_name_of_a_job_resolves(spark, sf):
    log = fx.log(spark, sf)
    columns = ("event_name", "name", "room_fqid", "fqid", "text_fqid")
    values = {c: tuple(sorted(r[0] for r in log.select(c).distinct().collect() if r[0])) for c in columns}
    params = replace(PARAMS, vocabularies=values)
    made = session_features(log, params, fx.skew(spark, sf)).rows.select("level_group", "feature").distinct().collect()
    df = spark.createDataFrame([(r.feature,) for r in made], "feature string")
    found = {r.feature: r for r in names.resolve_names(df, params).collect()}
    lost = [r.feature for r in made if found[r.feature].operator is None or found[r.feature].level_group != r.level_group]
    assert not lost, lost[:20]
