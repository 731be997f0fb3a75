from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from checks import fixture as fx
from checks.fixture import PARAMS
from sessionweave.operators import combos, deltas, longtable, models, vocabulary
from sessionweave.plans import bundle as B
from sessionweave.plans import training
from sessionweave.plans.features import selected_features, session_features
from sessionweave.presets import FQIDS, ROOMS, TEXT_FQIDS, FeatureParams
from sessionweave.workspace import Workspace, materialised, scratch_path
from tests.conftest import rows

LONG = "session_id long, level_group string, block string, feature string, zero boolean, value double"
MEMBERS = "session_id long, level_group string, block string"
FITTED = replace(PARAMS, fitted={"fqid": 0.5, "text_fqid": 0.45}, time_parts=0)
FOREST = models.ModelOptions(kind="forest", params={"base": {"max_depth": 3}, "n_estimators": [5]})


# --- vocabularies -------------------------------------------------------------


def test_rare_values_get_no_names(spark):
    """3,000 objects seen once, and one that every session has."""
    cells = spark.range(3000).select(
        (F.col("id") % 30).alias("session_id"), F.lit("0-4").alias("level_group"), F.lit("fqid").alias("dimension"), F.concat(F.lit("o"), "id").alias("value")
    )
    common = spark.range(30).select(F.col("id").alias("session_id"), F.lit("0-4").alias("level_group"), F.lit("fqid").alias("dimension"), F.lit("door").alias("value"))
    cells = cells.unionByName(common)
    found = vocabulary.fit_vocabulary(cells, combos.group_sessions(cells), {"fqid": 0.1})
    assert [tuple(r) for r in found.collect()] == [("0-4", "fqid", "door", 30)]
    kept = vocabulary.keep_vocabulary(cells.unionByName(cells.withColumn("dimension", F.lit("name"))), found, ["fqid"])
    assert kept.where("dimension = 'fqid'").select("value").distinct().count() == 1
    assert kept.where("dimension = 'name'").count() == cells.count()


def test_support_is_a_share_of_the_groups_sessions(spark):
    cells = spark.createDataFrame(
        [(s, g, "fqid", v) for g, n in (("0-4", 10), ("5-12", 2)) for s in range(n) for v in ("all", *(["some"] if s < 3 else []))],
        "session_id long, level_group string, dimension string, value string",
    )
    sessions = combos.group_sessions(cells)
    found = lambda share: {(r.level_group, r.value) for r in vocabulary.fit_vocabulary(cells, sessions, {"fqid": share}).collect()}
    assert found(0.3) == {("0-4", "all"), ("0-4", "some"), ("5-12", "all"), ("5-12", "some")}
    assert found(0.4) == {("0-4", "all"), ("5-12", "all"), ("5-12", "some")}
    assert found(0) == found(0.3)
    none = vocabulary.fit_vocabulary(cells.where("false"), sessions, {"fqid": 0.3})
    assert none.isEmpty()


def test_published_values_are_the_default():
    listed = FeatureParams().vocabularies
    assert (len(FQIDS), len(TEXT_FQIDS), len(ROOMS)) == (127, 126, 19)
    assert listed["fqid"] == FQIDS and listed["text_fqid"] == TEXT_FQIDS
    assert len(set(FQIDS)) == 127 and len(set(TEXT_FQIDS)) == 126


# --- vectors and merged groups --------------------------------------------------


def test_two_values_of_one_feature_are_an_error(spark):
    features = spark.createDataFrame([(1, "0-4", "base", "m", False, 4.0), (1, "0-4", "base", "m", False, 5.0)], LONG)
    members = spark.createDataFrame([(1, "0-4", "base")], MEMBERS)
    index = longtable.feature_index(longtable.feature_summary(features, members))
    with pytest.raises(Exception, match="two values of one feature"):
        longtable.sparse_cells(features, members, index).collect()


def test_names_that_become_one_column_are_an_error(spark):
    features = spark.createDataFrame([], LONG)
    with pytest.raises(ValueError, match="one column"):
        longtable.to_wide(features, spark.createDataFrame([], MEMBERS), [("room.1", "base", False), ("room-1", "base", False)])


def test_vectors_hold_every_feature_of_every_session(spark):
    features = spark.createDataFrame(
        [(1, "0-4", "base", "m", False, 4.0), (1, "0-4", "base", "n", True, 2.0), (2, "0-4", "late", "c", True, 3.0), (7, "5-12", "base", "x", False, 0.0)], LONG
    )
    members = spark.createDataFrame([(1, "0-4", "base"), (2, "0-4", "base"), (3, "0-4", "base"), (2, "0-4", "late"), (3, "0-4", "late"), (7, "5-12", "base")], MEMBERS)
    index = materialised(longtable.feature_index(longtable.feature_summary(features, members)))
    vectors = longtable.with_vectors(longtable.sparse_cells(features, members, index), index)
    got = {(r.session_id, r.feature): r.value for r in longtable.filled_rows(vectors, index).collect()}
    assert got == {
        (1, "c"): -1, (1, "m"): 4, (1, "n"): 2, (2, "c"): 3, (2, "m"): -1, (2, "n"): 0, (3, "c"): 0, (3, "m"): -1, (3, "n"): 0, (7, "x"): 0,
    }
    assert rows(longtable.filled_rows(vectors, index, -9).where("value = -9")) == rows(longtable.filled_rows(vectors, index).where("value = -1").withColumn("value", F.lit(-9.0)))


def test_groups_merge_without_a_gap(spark):
    """Session 2 lacks the middle group, so the last one gets nothing of the first."""
    members = spark.createDataFrame([(1, "a", "base"), (1, "b", "base"), (1, "c", "base"), (2, "a", "base"), (2, "c", "base"), (1, "a", "late")], MEMBERS)
    features = spark.createDataFrame([(s, g, "base", f"n_{g}", False, 1.0) for s, g in ((1, "a"), (1, "b"), (1, "c"), (2, "a"), (2, "c"))], LONG)
    got, inside = longtable.merge_groups(features, members, ("a", "b", "c"))
    assert got.columns == features.columns
    assert {(r.session_id, r.level_group, r.block, r.feature) for r in got.collect()} == {
        (1, "a", "base", "n_a"), (1, "b", "base", "n_b"), (1, "c", "base", "n_c"), (2, "a", "base", "n_a"), (2, "c", "base", "n_c"),
        (1, "b", "base@a", "n_a"), (1, "c", "base@a", "n_a"), (1, "c", "base@b", "n_b"),
    }
    assert (1, "c", "late@a") in {tuple(r) for r in inside.collect()}


def test_a_merge_reads_its_rows_once(spark):
    features = materialised(spark.createDataFrame([(1, "a", "base", "n_a", False, 1.0)], LONG))
    members = materialised(spark.createDataFrame([(1, "a", "base"), (1, "b", "base")], MEMBERS))
    merged, _ = longtable.merge_groups(features, members, ("a", "b"))
    plan = merged._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("feature#") and plan.count("Relation [session_id#") == 2  # rows and members


# --- saved runs -----------------------------------------------------------------


def test_parameters_come_back_as_they_were():
    for params in (FITTED, FeatureParams()):
        assert B.params_from_json(B.params_to_json(params)) == params


def test_a_new_log_is_seen_as_the_training_log_was(spark, sf):
    """The saved run gives the training sessions the vectors that trained it, whatever else the new log holds."""
    raw, skew, path = fx.raw_log(spark, sf), fx.skew(spark, sf), scratch_path(spark)
    train = materialised(raw.where("session_id % 3 = 0"))
    with Workspace(spark) as space:
        made = session_features(space.keep("log", lambda: deltas.event_deltas(train)), FITTED, skew, keep=space.keep)
        selection = selected_features(made, FITTED, merge=True, noise=2, keep=space.keep)
        index = materialised(longtable.feature_index(selection.kept))
        own = materialised(longtable.sparse_cells(selection.rows, selection.members, index))
        groups = training.group_tables(spark, selection, FITTED.level_groups, index)
        training.train_final(spark, groups, fx.answers(spark, sf), training.starting_scores(groups), FOREST, path, (1, 4), 0.61)
        B.save_bundle(B.Bundle(path, FITTED, index, selection.dictionaries, True, 2))
    new = materialised(raw.where("session_id % 3 <> 1"))
    bundle = B.with_models(spark, B.load_bundle(spark, path))
    assert (bundle.params, bundle.merge, bundle.noise, bundle.questions, bundle.threshold) == (FITTED, True, 2, (1, 4), 0.61)
    with Workspace(spark) as space:
        seen = B.new_features(new, bundle, space)
        cells = materialised(longtable.sparse_cells(seen.rows, seen.members, bundle.index))
    both = [df.where("session_id % 3 = 0").select("session_id", "level_group", "indices", F.transform("values", lambda x: F.round(x, 4)).alias("v")) for df in (own, cells)]
    assert rows(both[0]) == rows(both[1])
    scores = B.score_log(spark, new, bundle)
    sessions = new.select("session_id").distinct().count()
    assert scores.count() == 2 * sessions == scores.where("p between 0 and 1 and answer = cast(p > 0.61 as int)").count()
    values = {r.value for r in bundle.dictionaries.vocabulary.where("dimension = 'fqid'").collect()}
    assert values and not any(r.feature.endswith("_fqid_countsgrp0-4") and r.feature[:3] not in values | {"roo", "tx."} for r in bundle.index.collect())
