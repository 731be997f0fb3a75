"""Chain, folds, model options, saved models and files."""

import json
from dataclasses import replace

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from checks import fixture as fx
from checks import queries as q
from sessionweave.operators import chain, cleaning, clicks, longtable, models
from sessionweave.plans import features as plan
from sessionweave.plans import training
from sessionweave.plans.features import Selection
from sessionweave.workspace import bucketed, scratch_path
from sessionweave.presets import QUESTIONS
from sessionweave.sources import tables
from tests.conftest import rows


@pytest.fixture(scope="module")
def groups(spark, sf):
    """Two-number vectors per group: quick to train on."""
    out = {}
    for group in ("0-4", "5-12", "13-22"):
        wide = fx.log(spark, sf).where(F.col("level_group") == group).groupBy("session_id").agg(
            F.count("idx").cast("double").alias("n"), F.avg("elapsed_time_diff").alias("m")
        )
        table = wide.select("session_id", array_to_vector(F.array("n", "m")).alias("features"))
        out[group] = training.GroupTable(fx.written(spark, f"test/vectors/{group}", lambda t=table: t))
    return out


def test_vectors_keep_order_of_missing_values(spark):
    """Missing below everything, counts zero inside the block and -1 outside."""
    features = spark.createDataFrame(
        [(1, "0-4", "base", "m", False, 4.0), (2, "0-4", "late", "c", True, 3.0), (2, "0-4", "base", "m", False, 0.0)],
        "session_id long, level_group string, block string, feature string, zero boolean, value double",
    )
    members = spark.createDataFrame(
        [(1, "0-4", "base"), (2, "0-4", "base"), (3, "0-4", "base"), (2, "0-4", "late"), (3, "0-4", "late")],
        "session_id long, level_group string, block string",
    )
    summary = longtable.feature_summary(features, members)
    table = training.group_tables(spark, Selection(features, members, summary, summary), ("0-4",))["0-4"]
    got = {r.session_id: list(r.features.toArray()) for r in table.rows.collect()}
    assert got == {1: [-1.0, 5.0], 2: [3.0, 1.0], 3: [0.0, 0.0]}


def test_vectors_are_not_shuffled_again(spark):
    rows_ = bucketed(spark.range(100).select(F.col("id").alias("session_id"), F.lit(1.0).alias("x")), "session_id")
    labels = spark.range(100).select(F.col("id").alias("session_id"), F.lit(2).alias("q"), F.lit(1).alias("correct"))
    scores = labels.select("session_id", F.lit(1).alias("q"), F.lit(0.5).alias("p"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        joined = chain.chain_features(rows_, scores, labels, 2)
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    wide = [line for line in plan.splitlines() if "sessionweave_" in line]
    assert wide and all("Bucketed: true" in line for line in wide)
    # One exchange for the scores' pivot and one for the labels, none for the vectors.
    assert plan.count("Exchange hashpartitioning") == 2
    assert joined.count() == 100


def test_folds_are_stable_and_complete(spark, sf):
    sessions = fx.sessions(spark, sf)
    folds = cleaning.assign_folds(sessions, 3)
    assert rows(folds) == rows(cleaning.assign_folds(sessions.repartition(7).orderBy(F.desc("session_id")), 3))
    assert {r.fold for r in folds.collect()} <= {0, 1, 2}


@pytest.mark.parametrize("options", [q.BOOSTED, q.EARLY, q.FOREST, q.WEIGHTED], ids=["boosted", "early", "forest", "weighted"])
def test_out_of_fold_scores(spark, sf, groups, options):
    questions = (1, 2, 4)
    result = training.run_validation(spark, groups, fx.answers(spark, sf), options, questions, save_models=options is q.BOOSTED)
    got = result.predictions.collect()
    sessions = fx.sessions(spark, sf).count()
    assert len(got) == len({(r.session_id, r.q) for r in got}) == sessions * 18
    assert all(0.0 <= r.p <= 1.0 for r in got)
    assert result.rounds.count() == 6
    if options is q.BOOSTED:
        assert set(result.models) == {(t, k) for t in questions for k in (0, 1)}


def test_scores_come_from_models_that_did_not_see_the_session(spark, sf, groups):
    """With labels that equal the fold, a fold's model has only seen the other label."""
    sessions = cleaning.assign_folds(fx.sessions(spark, sf), 2)
    labels = sessions.select("session_id", F.lit(1).alias("q"), F.col("fold").alias("correct"))
    result = training.run_validation(spark, groups, labels, q.FOREST, (1,), folds=2)
    joined = result.predictions.where("q = 1").join(sessions, "session_id").collect()
    assert all(abs(r.p - (1 - r.fold)) < 1e-6 for r in joined)


def test_saved_models_score_as_trained(spark, sf, groups):
    labels, path = fx.answers(spark, sf), scratch_path(spark)
    training.train_final(spark, groups, labels, labels, q.BOOSTED, path, (1, 2))
    scores = training.score_saved(spark, path, groups, (1, 2), labels.select("session_id", "q", "p"))
    assert scores.where("q <= 2").count() == 2 * fx.sessions(spark, sf).count()
    meta = {r.q: r for r in spark.read.parquet(f"{path}/metadata").collect()}
    assert meta[2].inputs == ["features", "p_q1"] and meta[1].level_group == "0-4"


def test_missing_label_stops_training(spark, sf, groups):
    labels = fx.answers(spark, sf).where("session_id <> 3")
    with pytest.raises(chain.MissingLabels):
        training.run_validation(spark, groups, labels, q.BOOSTED, (1,))


def test_parameter_order():
    each = {5: {"base": {"learning_rate": 0.5}, "n_estimators": [9]}}
    options = models.ModelOptions(each=each, seed=7)
    assert models.resolve_params(options, 5) == {"learning_rate": 0.5, "n_estimators": 9, "random_state": 7}
    assert models.resolve_params(options, 6)["n_estimators"] == 439
    options = models.ModelOptions(best_rounds={6: 11}, overrides={"max_depth": 1})
    resolved = models.resolve_params(options, 6)
    assert (resolved["n_estimators"], resolved["max_depth"]) == (11, 1)
    assert models.spark_params(resolved, "boosted") == {
        "stepSize": 0.02, "maxDepth": 1, "subsamplingRate": 0.8, "featureSubsetStrategy": "0.5", "seed": 42, "maxIter": 11,
    }
    with pytest.raises(ValueError):
        models.classifier(models.ModelOptions(kind="other"), 1)


def test_question_groups():
    assert [chain.group_name(t) for t in (1, 3, 4, 13, 14, 18)] == ["0-4", "0-4", "5-12", "5-12", "13-22", "13-22"]


def test_priors(spark):
    start = chain.oof_init(spark.createDataFrame([(1,)], "session_id long")).collect()
    assert {r.q for r in start} == set(QUESTIONS) and start[12].p == 0.275


def test_oof_csv_and_rows(spark, sf):
    answers = fx.answers(spark, sf).select("session_id", "q", "p")
    path = tables.write_oof_csv(answers, scratch_path(spark), QUESTIONS)
    back = tables.oof_rows(tables.read_oof_csv(spark, path, QUESTIONS), QUESTIONS)
    assert rows(back) == rows(answers)


def test_params_and_name_files(spark, tmp_path):
    (tmp_path / "p.json").write_text(json.dumps({"base": {"max_depth": 4}, "n_estimators": [10]}, indent=2))
    assert tables.read_params(spark, str(tmp_path / "p.json"))["n_estimators"] == [10]
    each = tmp_path / "each"
    each.mkdir()
    (each / "q5.json").write_text('{"base": {"gamma": 0.5}, "n_estimators": [7]}')
    (each / "q11.json").write_text('{"base": {}, "n_estimators": [8]}')
    assert tables.read_question_params(spark, str(each)) == {
        5: {"base": {"gamma": 0.5}, "n_estimators": [7]}, 11: {"base": {}, "n_estimators": [8]},
    }
    (tmp_path / "names.json").write_text('[\n "a.b",\n "c"\n]')
    assert rows(tables.read_name_list(spark, str(tmp_path / "names.json"))) == [("a.b",), ("c",)]


def test_room_embedding_against_eigenvectors(spark, sf):
    """Points equal the scaled grid projected on its first two eigenvectors, up to sign."""
    slotted = clicks.with_slots(q.clipped(spark, sf), q.axes(spark, sf)).where("level_group = '5-12' and room_fqid = 'room.0'")
    scale = {(r.room_x, r.room_y): r for r in q.scale(spark, sf).where("level_group = '5-12' and room_fqid = 'room.0'").collect()}
    cells = slotted.collect()
    ids = sorted({c.session_id for c in cells})
    grid = np.zeros((len(ids), cells[0].grid_size))
    for c in cells:
        grid[ids.index(c.session_id), c.slot] = c.n / scale[c.room_x, c.room_y].scale
    grid -= grid.mean(axis=0)
    values, axes = np.linalg.eigh(np.cov(grid.T))
    want = grid @ axes[:, np.argsort(values)[::-1][:2]]
    got = {r.session_id: (r.axis0, r.axis1) for r in q.room_grid_pca(spark, sf).where("level_group = '5-12' and room_fqid = 'room.0'").collect()}
    got = np.array([got[i] for i in ids])
    for k in range(2):
        assert np.allclose(np.abs(got[:, k]), np.abs(want[:, k]), atol=1e-6)


def test_event_log_file(spark, tmp_path):
    df = spark.createDataFrame([(1, 0, 5, True)], "session_id long, index long, elapsed_time long, hq boolean")
    df.write.parquet(str(tmp_path / "log"))
    assert tables.read_event_log(spark, str(tmp_path / "log")).columns == ["session_id", "idx", "elapsed_time"]


def test_run_results_append(spark, tmp_path):
    scores = spark.createDataFrame([("overall", 0.7)], "score string, value double")
    for run in ("a", "b"):
        tables.append_run_result(scores, run, str(tmp_path / "runs"), {"folds": 2})
    back = tables.read_run_results(spark, str(tmp_path / "runs"))
    assert {(r.run, r.value, r.options) for r in back.collect()} == {("a", 0.7, '{"folds": 2}'), ("b", 0.7, '{"folds": 2}')}


def test_early_stopping_keeps_the_best_round_within_patience(spark):
    assert models.best_round([0.9, 0.8, 0.85, 0.7], 1) == 2
    assert models.best_round([0.9, 0.8, 0.85, 0.7], 5) == 4
    assert models.best_round([0.5, 0.6, 0.7], 2) == 1
    rows = spark.range(400).select(
        F.col("id").alias("session_id"), ((F.col("id") * 7) % 10 < 6).cast("int").alias("correct"), (F.col("id") % 10).cast("double").alias("x")
    )
    params = {"base": {"learning_rate": 0.02, "max_depth": 2, "early_stopping_rounds": 5}, "n_estimators": [12]}
    options = models.ModelOptions(params=params)
    kept = models.fit_stopped(rows.where("session_id < 200"), rows.where("session_id >= 200"), ["x"], options, 1, False)
    assert models.rounds_of(kept) == 12
    noise = rows.withColumn("correct", F.when(F.col("session_id") < 200, F.col("correct")).otherwise(1 - F.col("correct")))
    stopped = models.fit_stopped(noise.where("session_id < 200"), noise.where("session_id >= 200"), ["x"], options, 1, False)
    assert models.rounds_of(stopped) == 1


def test_unknown_parameters_are_errors():
    with pytest.raises(ValueError, match="no_such"):
        models.spark_params({"n_estimators": 1, "no_such": 2}, "boosted")
    assert models.ignored_params({"alpha": 8, "max_depth": 3}) == ["alpha"]


def test_sessions_without_rows_keep_their_starting_score(spark, sf, groups):
    lone = spark.createDataFrame([(-5,)], "session_id long")
    start = chain.oof_init(lone.unionByName(fx.sessions(spark, sf)))
    result = training.run_validation(spark, groups, fx.answers(spark, sf), q.BOOSTED, (1,), start=start)
    got = {r.q: r.p for r in result.predictions.where("session_id = -5").collect()}
    assert got == {r.q: r.p for r in chain.oof_init(lone).collect()} and len(got) == 18
    zeros = training.starting_scores(groups, zero=True)
    assert zeros.where("p <> 0").count() == 0 and zeros.count() == 18 * fx.sessions(spark, sf).count()


@pytest.fixture(scope="module")
def learnable(spark):
    """Labels that mostly follow one of three columns; the rest is chance."""
    mark = lambda seed: (F.abs(F.xxhash64("session_id", F.lit(seed))) % 1000) / 1000.0
    rows_ = spark.range(600).select(F.col("id").alias("session_id"))
    rows_ = rows_.withColumns({"x": mark(1), "y": mark(2), "z": mark(3)}).withColumn("vector", array_to_vector(F.array("x", "y", "z")))
    return fx.written(spark, "test/learnable", lambda: rows_.drop("vector").withColumn("correct", (F.col("x") + 0.9 * mark(4) > 1).cast("int")))


def _early(rounds, wait, **more):
    base = {"learning_rate": 0.5, "max_depth": 3, "early_stopping_rounds": wait, **more}
    return models.ModelOptions(params={"base": base, "n_estimators": [rounds]})


def test_boosting_stops_at_the_first_best_round_and_grows_no_more(learnable, monkeypatch):
    train, held = learnable.where("session_id % 3 > 0"), learnable.where("session_id % 3 = 0")
    grown, plain = [], models.classifier
    monkeypatch.setattr(models, "classifier", lambda o, q, w=False, rounds=None: grown.append(rounds) or plain(o, q, w, rounds))
    stopped = models.fit_stopped(train, held, ["x", "y", "z"], _early(80, 4), 1, False)
    assert max(grown) < 80
    monkeypatch.undo()
    whole = models.fit(train, ["x", "y", "z"], models.classifier(_early(max(grown), 4), 1))
    losses = whole.stages[-1].evaluateEachIteration(whole.stages[0].transform(held.withColumn("correct", F.col("correct").cast("double"))))
    best = models.best_round(losses, 4)
    assert models.rounds_of(stopped) == best < max(grown)
    # The first trees score as a model fitted with so many rounds.
    refit = models.fit(train, ["x", "y", "z"], models.classifier(_early(80, 4), 1, rounds=best))
    assert rows(models.score(stopped, held)) == rows(models.score(refit, held))


def test_a_shortened_model_is_saved_and_read(spark, learnable):
    model = models.first_trees(models.fit(learnable, ["x", "y", "z"], models.classifier(_early(6, 0), 1)), 2)
    path = scratch_path(spark)
    model.write().save(path)
    back = PipelineModel.load(path)
    assert models.rounds_of(back) == 2
    assert rows(models.score(back, learnable)) == rows(models.score(model, learnable))


def test_scores_part_learnable_labels(learnable):
    for options in (_early(10, 0), models.ModelOptions(kind="forest", params={"base": {"max_depth": 4}, "n_estimators": [20]})):
        model = models.fit(learnable.where("session_id % 2 = 0"), ["x", "y", "z"], models.classifier(options, 1))
        held = learnable.where("session_id % 2 = 1")
        means = {r.correct: r.p for r in models.score(model, held).join(held, "session_id").groupBy("correct").agg(F.avg("p").alias("p")).collect()}
        assert means[1] > means[0] + 0.3


def test_leaves_become_depth():
    assert models.spark_params({"n_estimators": 5, "num_leaves": 31}, "boosted")["maxDepth"] == 5
    assert models.spark_params({"n_estimators": 5, "num_leaves": 31, "max_depth": 4}, "boosted")["maxDepth"] == 4
    assert models.spark_params({"n_estimators": 5, "max_depth": -1, "num_leaves": 8}, "boosted")["maxDepth"] == 3


@pytest.mark.parametrize("early", [False, True])
def test_rows_are_assembled_once_for_all_passes(spark, learnable, early):
    read = spark.sparkContext.accumulator(0)

    def seen(x):
        read.add(1)
        return x

    rows_ = learnable.withColumn("x", F.udf(seen, "double")("x"))
    train, held = rows_.where("session_id % 3 > 0"), learnable.where("session_id % 3 = 0")
    options = _early(8, 1) if early else _early(3, 0)
    if early:
        models.fit_stopped(train, held, ["x", "y", "z"], options, 1, False)
    else:
        models.fit(train, ["x", "y", "z"], models.classifier(options, 1))
    assert read.value == train.count() == 400


def test_kept_rows_are_not_summed_up_again(spark, monkeypatch):
    rows_ = [(s, "0-4", "base", "m", False, float(s)) for s in range(4)] + [(s, "0-4", "base", "same", False, 1.0) for s in range(4)]
    rows_ += [(0, "0-4", "late", "c", True, 3.0)]
    features = spark.createDataFrame(rows_, "session_id long, level_group string, block string, feature string, zero boolean, value double")
    members = [(s, "0-4", "base") for s in range(4)] + [(s, "0-4", "late") for s in (0, 1)]
    members = spark.createDataFrame(members, "session_id long, level_group string, block string")
    calls, plain = [], longtable.feature_summary
    monkeypatch.setattr(longtable, "feature_summary", lambda *a: calls.append(a) or plain(*a))
    chosen = plan.selected_features(plan.Features(features, members), replace(fx.PARAMS, time_parts=0))
    assert len(calls) == 1
    assert rows(chosen.summary) == rows(plain(chosen.rows, members, chosen.kept)) and {r.feature for r in chosen.kept.collect()} == {"m", "c"}
    assert {r.feature for r in chosen.rows.collect()} == {"m", "c"}
