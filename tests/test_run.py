"""A whole run over files in the data set's layout."""

import json
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from checks import fixture as fx
from checks.fixture import PARAMS
from sessionweave.operators import models
from sessionweave.plans import run as runs
from sessionweave.plans.bundle import load_bundle
from sessionweave.plans.features import fit_dictionaries, session_features
from sessionweave.sources import tables
from sessionweave.operators import longtable
from sessionweave.workspace import Workspace, materialised
from tests.conftest import rows

SMALL = replace(PARAMS, version=2, time_parts=1)
BOOSTED = models.ModelOptions(
    params={"base": {"learning_rate": 0.1, "max_depth": 2, "early_stopping_rounds": 5}, "n_estimators": [3]}
)


@pytest.fixture(scope="module")
def files(spark, sf, tmp_path_factory):
    path = tmp_path_factory.mktemp("input")
    # Twelve digits, as the time parts are read from the id.
    stamped = lambda df: df.withColumn("session_id", F.col("session_id") + 200109030000000000)
    log = stamped(fx.raw_log(spark, sf)).withColumnRenamed("idx", "index").withColumn("hq", F.lit(0))
    labels = stamped(fx.answers(spark, sf)).select(
        F.concat(F.col("session_id").cast("string"), F.lit("_q"), F.col("q").cast("string")).alias("session_id"), "correct"
    )
    log.write.parquet(f"{path}/train.parquet")
    labels.write.parquet(f"{path}/train_labels.parquet")
    log.withColumn("original", (F.col("session_id") % 2).cast("int")).write.parquet(f"{path}/train_additional.parquet")
    labels.write.parquet(f"{path}/train_labels_additional.parquet")
    (path / "drop.json").write_text(json.dumps(["session_number_grp0-4", "no_such_name"]))
    return str(path)


def test_load_options(spark, files):
    data = runs.load_dataset(spark, files, runs.LoadOptions(sampling=4))
    assert data.log.select("session_id").distinct().count() == 4
    assert data.labels.count() == 4 * 18 and data.originals is None
    data = runs.load_dataset(spark, files, runs.LoadOptions("additional"))
    assert data.originals.where("session_id % 2 = 0").isEmpty() and not data.originals.isEmpty()
    assert runs.load_dataset(spark, files, runs.LoadOptions(least_events=10**6)).log.isEmpty()


def test_whole_run(spark, files, tmp_path):
    options = runs.RunOptions(
        load=runs.LoadOptions("additional"), features=SMALL, model=BOOSTED, merge=True, noise=2,
        drop_list=f"{files}/drop.json", questions=(1, 4), folds=2,
    )
    result = runs.run(spark, files, str(tmp_path), "first", options)
    sessions = runs.load_dataset(spark, files, options.load).log.select("session_id").distinct().count()
    assert result.predictions.count() == 18 * sessions
    assert {r.q for r in result.by_question.collect()} == {1, 4}
    assert {r.score for r in tables.read_run_results(spark, f"{tmp_path}/runs").collect()} == {"overall", "q1", "q4"}
    meta = {r.q: r for r in spark.read.parquet(f"{result.models}/metadata").collect()}
    assert meta[4].inputs[0] == "features" and set(meta) == {1, 4}
    saved = load_bundle(spark, result.models)
    names = {r.feature: r["index"] for r in saved.index.where("level_group = '5-12'").collect()}
    assert {"year", "random0", "random1"} <= set(names)
    assert sorted(names.values()) == list(range(len(names)))
    assert "session_number_grp5-12" in names and saved.index.where("level_group = '0-4' and feature = 'session_number_grp0-4'").isEmpty()
    assert any(n.endswith("grp0-4") for n in names)
    back = tables.read_oof_csv(spark, f"{tmp_path}/first/oof_predict_proba", (1, 4))
    assert back.count() == sessions


def test_versions_and_options_switch_blocks(spark, sf):
    log, skew = fx.log(spark, sf), fx.skew(spark, sf)

    def names(**changes):
        made = session_features(log, replace(PARAMS, **changes), skew)
        return {r.feature for r in made.rows.select("feature").distinct().collect()}

    bare = names(version=1, extra=False, level_diff=False, cut_above=False, room_click=False)
    full = names()
    assert bare < full
    for part in ("click_same_max", "elapsed_time_over", "_text_ET_quantile", "elapsed_time_total_level", "_above", "navigate_index", "_extra_"):
        assert not any(part in n for n in bare), part
        assert any(part in n for n in full), part


def test_capped_gaps_do_not_change_flags(spark, sf):
    log, skew = fx.log(spark, sf), fx.skew(spark, sf)
    pick = F.col("feature").isin("elapsed_time_over200000000_grp0-4", "elapsed_time_diff_max_grp0-4")
    values = {}
    for cap in (False, True):
        made = session_features(log, replace(PARAMS, cap_gaps=cap), skew).rows.where(pick)
        values[cap] = {(r.session_id, r.feature): r.value for r in made.collect()}
    over = [k for k in values[False] if "over" in k[1]]
    assert over and all(values[False][k] == values[True][k] for k in over)
    assert max(v for (_, f), v in values[True].items() if "max" in f) == PARAMS.gap_cap


def test_fitted_dictionaries_apply_to_other_sessions(spark, sf):
    log, skew = fx.log(spark, sf), fx.skew(spark, sf)
    fitted = fit_dictionaries(log, PARAMS)
    one = log.where("session_id = 3")
    whole = session_features(log, PARAMS, skew, fitted, Workspace(spark).keep).rows.where("session_id = 3")
    part = session_features(one, PARAMS, skew, fitted, Workspace(spark).keep).rows
    assert rows(part) == rows(whole)


def test_sums_over_values_give_the_total(spark, sf):
    """Counts by room, plus none missing, give the session's event count."""
    rows_ = fx.log(spark, sf)
    made = session_features(rows_, replace(PARAMS, version=1), fx.skew(spark, sf)).rows
    by_room = made.where("feature like '%_room_fqid_counts%'").groupBy("session_id", "level_group").agg(F.sum("value").alias("n"))
    number = made.where("feature like 'session_number%'").select("session_id", "level_group", F.col("value").alias("n"))
    assert rows(by_room) == rows(number)


def test_feature_names(spark, sf):
    """Names (fixed values) of the wide table with the group suffix."""
    made = session_features(fx.log(spark, sf), PARAMS, fx.skew(spark, sf)).rows
    names = {r.feature for r in made.select("feature").distinct().collect()}
    expected = {
        "session_number_grp0-4", "fqid_unique_grp5-12", "page_quantile4_grp13-22", "hover_duration_std_grp0-4",
        "click_event_name_countsgrp0-4", "click_ET_quantile8_grp0-4", "click_ET_mean_xgrp5-12", "basic_name_countsgrp0-4",
        "basic_ET_std_grp0-4", "room.1_room_fqid_countsgrp0-4", "room.1_ET_sum_grp0-4", "fq1_fqid_countsgrp5-12",
        "tx.1_text_fqid_countsgrp13-22", "3_LEVEL_countgrp0-4", "3_ET_sum_grp0-4", "0-4_LEVEL_group_countgrp0-4",
        "0-4_ET_mean_grp0-4", "word_this_grp0-4", "word_max_this_grp0-4", "elapsed_time_total_level_2_grp0-4",
        "elapsed_time_level_diff_fixed_1_grp0-4", "elapsed_time_max0-4_grp0-4", "elapsed_time_diff_fixed_max0_3_min4_grp0-4",
        "elapsed_time_diff_fixed_max5-11_min12_grp5-12", "index_count_room.1_grp0-4_above", "elapsed_time_diff_to_4_grp0-4_above",
        "both_texts_duration_extra_grp0-4", "fq3_to_fq4_indexCount_extra_grp5-12", "to_tx2_et_extra_grp0-4",
        "click_same_max_grp0-4", "elapsed_time_over1000000_grp0-4", "tx.1_text_ET_quantile7_grp0-4", "room.1_room_ET_quantile9_grp0-4",
        "click_basic_count_grp0-4", "click_2_count_grp0-4",
    }
    assert expected <= names, expected - names
    assert not any("fqid_None" in n and "_ET_sum" not in n and "_counts" not in n and "ET_count" not in n for n in names)


def test_a_workspace_belongs_to_one_log(spark, sf):
    log, skew = fx.log(spark, sf), fx.skew(spark, sf)
    first, second = (materialised(log.where(f"session_id % 2 = {i}")) for i in (0, 1))
    with Workspace(spark) as space:
        fitted = fit_dictionaries(first, PARAMS, space.keep)
        with pytest.raises(ValueError, match="another log"):
            session_features(second, PARAMS, skew, fitted, space.keep)
        with Workspace(spark) as other:
            made = session_features(second, PARAMS, skew, fitted, other.keep)
            got = made.rows.where("block = 'navigate' or feature like '%navigate%'").select("session_id").distinct()
            assert made.rows.where("session_id % 2 = 0").isEmpty() and not got.isEmpty()
        path = space._tables["fqid_cells"][0]
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)


def test_listed_names_follow_renamings(spark):
    names = spark.createDataFrame([("click_3_ET_min_grp0-4",), ("map_hover_ET_min_grp0-4",), ("click_same_over5_count_grp0-4",)], "feature string")
    got = {r.feature for r in longtable.current_names(names).collect()}
    assert got == {"click_3_count_grp0-4", "map_hover_ET_min_grp0-4", "click_same_over_grp0-4"}
