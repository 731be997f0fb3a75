"""One DataFrame per operator over the driver's tables."""

from __future__ import annotations

import json
from dataclasses import replace
from functools import cache

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks import fixture as fx
from checks.fixture import PARAMS
from checks.oracles import DROPPED
from sessionweave.functions.expressions import grid_bin, time_parts, year_weight
from sessionweave.operators import (
    chain,
    cleaning,
    clicks,
    combos,
    deltas,
    evaluate,
    levels,
    longtable,
    models,
    quantiles,
    stats,
    vocabulary,
)
from sessionweave.plans import bundle as saved_run
from sessionweave.plans import features as plan
from sessionweave.plans import training
from sessionweave.workspace import Workspace, materialised, remembered, scratch_path, written
from sessionweave.presets import BOOSTED_EARLY_STOP_PARAMS, BOOSTED_PARAMS, DEFAULT_THRESHOLD, FOREST_PARAMS, QUESTIONS
from sessionweave.sources import tables

KEYS = stats.KEYS
SHARES = (0.1, 0.2, 0.4, 0.6, 0.8, 0.9)
TEXT_SHARES = (0.2, 0.7, 0.9)


def rounded(df: DataFrame) -> DataFrame:
    """Rounded means and deviations, for comparison across engines.

    Gap means are ratios of whole numbers (4 places); other means are sums of
    two-decimal values and need a place beyond their own ties (7).
    """
    places = {
        c: 2 if c.endswith("std") else 4 if c.endswith(("et_mean", "elapsed_time_diff_mean")) else 7
        for c in df.columns
        if c.endswith(("mean", "std"))
    }
    return df.withColumns({c: F.round(c, n) for c, n in places.items()})


def by_value(dimension: str, *columns: str):
    def run(spark, sf):
        table = stats.value_stats(fx.log(spark, sf), [dimension], PARAMS)
        return rounded(table.select(*KEYS, "value", *columns))

    return run


def quantiles_by(dimension: str, shares):
    def run(spark, sf):
        rows = stats.value_rows(fx.log(spark, sf), [dimension], PARAMS, ["elapsed_time_diff"])
        return quantiles.nearest_quantiles(
            rows, [*KEYS, "value"], ["elapsed_time_diff"], shares, fx.skew(spark, sf)
        )

    return run


def event_deltas(spark, sf):
    return deltas.event_deltas(fx.raw_log(spark, sf), fx.skew(spark, sf)).select(
        *KEYS, "idx", "page", "elapsed_time_diff", "elapsed_time_diff_to", "location_x_diff", "location_y_diff", "fqid", "text_fqid"
    )


def grid_bins(spark, sf):
    x, y = F.col("room_coor_x"), F.col("room_coor_y")
    return fx.raw_log(spark, sf).select(
        "session_id",
        "idx",
        grid_bin(x, PARAMS.cell_size).alias("room_x"),
        grid_bin(y, PARAMS.cell_size).alias("room_y"),
        grid_bin(x, PARAMS.grid_size).alias("grid_x"),
        grid_bin(y, PARAMS.grid_size).alias("grid_y"),
    )


def flagged(spark, sf):
    return deltas.gap_flags(fx.log(spark, sf), PARAMS.gap_flags)


FLAGS = [f"elapsed_time_over{n}" for n in PARAMS.gap_flags]

FIRST = {
    "scan_event_log": lambda s, sf: fx.events_as_log(fx.table(s, sf, "events"), fx.skew(s, sf)),
    "filter_level_group": lambda s, sf: fx.raw_log(s, sf).where("level_group = '5-12'"),
    "distinct_sessions": fx.sessions,
    "fill_sentinels": lambda s, sf: deltas.fill_sentinels(fx.raw_log(s, sf)).select("session_id", "idx", "fqid", "text_fqid"),
    "event_deltas": event_deltas,
    "gap_flags": lambda s, sf: flagged(s, sf).select("session_id", "idx", *FLAGS),
    "gap_flag_sums": lambda s, sf: stats.gap_flag_sums(flagged(s, sf), PARAMS.gap_flags),
    "cap_gap": lambda s, sf: deltas.cap_gap(fx.log(s, sf), PARAMS.gap_cap).select("session_id", "idx", "elapsed_time_diff"),
    "grid_bins": grid_bins,
    "session_counts": lambda s, sf: stats.session_counts(fx.log(s, sf)),
    "session_distincts": lambda s, sf: stats.session_distincts(fx.log(s, sf)),
    "numeric_stats": lambda s, sf: rounded(stats.numeric_stats(fx.log(s, sf))),
    "numeric_quantiles": lambda s, sf: quantiles.nearest_quantiles(
        fx.log(s, sf), KEYS, list(stats.NUMERIC_COLUMNS), SHARES, fx.skew(s, sf)
    ),
    "by_event_name": by_value("event_name", "n", "et_mean", "et_std", "et_max", "et_min"),
    "by_event_name_quantiles": quantiles_by("event_name", SHARES),
    "by_event_name_move": by_value("event_name", "x_mean", "x_std", "x_max", "x_min"),
    "by_name": by_value("name", "n", "et_mean", "et_max", "et_min", "et_std"),
    "by_room": by_value("room_fqid", "n", "et_std", "et_mean", "et_max", "et_min", "et_sum"),
    "by_fqid": by_value("fqid", "n", "et_std", "et_mean", "et_max", "et_min", "et_sum"),
    "by_text_fqid": by_value("text_fqid", "n", "et_std", "et_mean", "et_max", "et_min", "et_sum"),
    "by_level": by_value("level", "n", "et_std", "et_mean", "et_sum"),
    "by_level_group": by_value("level_group", "n", "et_std", "et_mean", "et_sum"),
    "word_features": by_value("word", "n", "et_mean", "et_std", "et_max", "et_sum"),
    "value_stats_one_pass": lambda s, sf: rounded(
        stats.value_stats(fx.log(s, sf), [*stats.DIMENSIONS, "word"], PARAMS)
    ),
    "by_text_quantiles": quantiles_by("text_fqid", TEXT_SHARES),
    "by_room_quantiles": quantiles_by("room_fqid", TEXT_SHARES),
}



# --- levels, milestones, combinations, clicks ---------------------------------


def combo_cells(spark, sf, combo):
    name = f"{sf}/cells/{combo[0]}"
    return written(spark, name, lambda: combos.combo_cells(fx.log(spark, sf), combo))


def dictionary(spark, sf, combo, support):
    def build():
        sessions = combos.group_sessions(fx.log(spark, sf))
        return combos.mine_combos(combo_cells(spark, sf, combo), sessions, combo, support)

    return written(spark, f"{sf}/dictionary/{combo[0]}", build)


def flr(spark, sf):
    return dictionary(spark, sf, combos.FQID_COMBO, PARAMS.support)


def tl(spark, sf):
    return dictionary(spark, sf, combos.TEXT_COMBO, PARAMS.text_support)


def combo_features(spark, sf):
    fqid = combos.combo_features(combo_cells(spark, sf, combos.FQID_COMBO), flr(spark, sf), combos.FQID_COMBO)
    text = combos.combo_features(combo_cells(spark, sf, combos.TEXT_COMBO), tl(spark, sf), combos.TEXT_COMBO)
    level = F.col("level").cast("string")
    return fqid.select(*KEYS, F.concat_ws("_", "fqid", "room_fqid", level).alias("combo"), "et_sum", "n").unionByName(
        text.select(*KEYS, F.concat_ws("_", "text_fqid", level).alias("combo"), "et_sum", "n")
    )


def navigate_cells(spark, sf):
    return written(spark, f"{sf}/navigate", lambda: clicks.navigate_cells(fx.log(spark, sf), PARAMS))


def popularity(spark, sf):
    """Written, so that the planner knows its size when it is joined."""
    return written(spark, f"{sf}/popularity", lambda: clicks.cell_popularity(navigate_cells(spark, sf), PARAMS))


def grid(spark, sf):
    return written(spark, f"{sf}/grid", lambda: clicks.room_grid_cells(fx.log(spark, sf), PARAMS))


def clipped(spark, sf):
    return clicks.clip_cells(grid(spark, sf), PARAMS)


def scale(spark, sf):
    return written(spark, f"{sf}/scale", lambda: clicks.room_grid_scale(clipped(spark, sf)))


def axes(spark, sf):
    return written(spark, f"{sf}/axes", lambda: clicks.room_grid_axes(grid(spark, sf)))


SECOND = {
    "level_times": lambda s, sf: levels.level_times(fx.log(s, sf)),
    "level_time_features": lambda s, sf: levels.level_time_features(fx.log(s, sf), PARAMS),
    "session_thresholds": lambda s, sf: levels.session_thresholds(fx.log(s, sf), PARAMS),
    "above_threshold_features": lambda s, sf: levels.above_threshold_features(fx.log(s, sf), PARAMS, fx.skew(s, sf)),
    "milestone_features": lambda s, sf: stats.milestone_features(fx.log(s, sf), PARAMS),
    "milestone_transitions": lambda s, sf: stats.milestone_transitions(fx.log(s, sf), PARAMS),
    "frequent_fqid_level_room": lambda s, sf: combos.frequent_fqid_level_room(fx.log(s, sf), PARAMS),
    "frequent_text_level": lambda s, sf: combos.frequent_text_level(fx.log(s, sf), PARAMS),
    "combo_features": combo_features,
    "event_level_counts": lambda s, sf: combos.event_level_counts(fx.log(s, sf), PARAMS),
    "event_name_pair_counts": lambda s, sf: combos.event_name_pair_counts(fx.log(s, sf), PARAMS),
    "repeat_clicks": lambda s, sf: clicks.repeat_clicks(fx.log(s, sf), PARAMS),
    "cell_popularity": lambda s, sf: clicks.cell_popularity(navigate_cells(s, sf), PARAMS),
    "navigate_category_counts": lambda s, sf: clicks.navigate_category_counts(
        navigate_cells(s, sf), popularity(s, sf), PARAMS
    ),
    "room_grid_counts": lambda s, sf: clicks.with_slots(grid(s, sf), axes(s, sf)),
    "room_grid_clipped": clipped,
    "room_grid_axes": lambda s, sf: clicks.room_grid_axes(grid(s, sf)),
    "one_hot_cells": lambda s, sf: clicks.one_hot_cells(grid(s, sf)),
    "room_grid_scale": lambda s, sf: clicks.room_grid_scale(clipped(s, sf)).withColumns({c: F.round(c, 7) for c in ("mean", "scale")}),
    "room_grid_scaled": lambda s, sf: clicks.room_grid_scaled(clipped(s, sf), scale(s, sf)).withColumn(
        "scaled", F.round("scaled", 6)
    ),
}


# --- cleaning, labels, evaluation ---------------------------------------------


def unlocated_sessions(spark, sf):
    """Sessions where more than 12 % of the rows have no coordinates."""
    share = F.count("room_coor_x") < 0.88 * F.count(F.lit(1))
    return fx.raw_log(spark, sf).groupBy("session_id").agg(share.alias("drop")).where("drop").select("session_id")


def exclude_sessions(spark, sf):
    kept = cleaning.exclude_sessions(fx.raw_log(spark, sf), unlocated_sessions(spark, sf), fx.skew(spark, sf))
    return kept.select("session_id", "idx")


def sample(spark, sf):
    return cleaning.sample_sessions(fx.table(spark, sf, "events").select(F.col("user_id").alias("session_id")), 10)


def label_file(spark, sf):
    """Labels as the file holds them, written and read by the label reader."""
    path = scratch_path(spark)
    fx.answers(spark, sf).select(F.col("label_id").alias("session_id"), "correct").write.parquet(path)
    return tables.read_labels(spark, path)


def stamped_sessions(spark, sf):
    """Session ids that carry their start time in their digits."""
    user = F.col("user_id").cast("string")
    stamp = F.concat(
        (F.col("user_id") % 4 + 20).cast("string"), F.date_format("t0", "MMddHHmmss"), F.lpad(user, 5, "0")
    )
    starts = fx.table(spark, sf, "events").groupBy("user_id").agg(F.min("ts").alias("t0"))
    return starts.select(F.col("user_id").alias("session_id"), stamp.cast("long").alias("stamp"))


def session_time_parts(spark, sf):
    return stamped_sessions(spark, sf).select("session_id", *[c.alias(n) for n, c in time_parts(F.col("stamp")).items()])


def originals(spark, sf):
    signups = F.count_if(F.col("event_type") == "signup")
    users = fx.table(spark, sf, "events").groupBy(F.col("user_id").alias("session_id")).agg(signups.alias("n"))
    return users.where("n >= 10").select("session_id")


def score_columns(df):
    return df.withColumn("macro_f1", F.round("macro_f1", 9))


def mean_best_iterations(spark, sf):
    """Mean per question of one whole number per (question, fold)."""
    rows = cleaning.assign_folds(fx.answers(spark, sf), 5)
    rounds = rows.groupBy("q", "fold").agg(F.sum("correct").alias("best_iteration"))
    table = tables.read_csv(
        spark,
        tables.write_csv(models.mean_best_iterations(rounds), scratch_path(spark)),
        "q int, best_iteration int",
    )
    return table


def written_oof(spark, sf):
    return tables.read_oof(spark, tables.write_oof(fx.answers(spark, sf), scratch_path(spark)))


def csv_roundtrip(spark, sf):
    path = tables.write_oof_csv(fx.answers(spark, sf), scratch_path(spark), QUESTIONS)
    return tables.read_oof_csv(spark, path, QUESTIONS)


def load_dictionaries(spark, sf):
    """Fitted dictionaries written as CSV and read back, as rows of one table."""
    path = scratch_path(spark)
    tables.save_dictionaries(path, flr_list=flr(spark, sf), tl_list=tl(spark, sf), navigate_master=popularity(spark, sf))
    back = tables.load_dictionaries(spark, path)
    none = F.lit(None)
    parts = [
        ("flr_list", "fqid", F.col("room_fqid"), F.col("level"), none.cast("long"), none.cast("int")),
        ("tl_list", "text_fqid", none.cast("string"), F.col("level"), none.cast("long"), none.cast("int")),
        ("navigate_master", "room_fqid", none.cast("string"), F.col("room_x").cast("int"), F.col("room_y"), F.col("category")),
    ]
    return longtable.stack_blocks(
        [
            back[n].select(
                F.lit(n).alias("dictionary"), "level_group", F.col(a).alias("a"), b.alias("b"), i.alias("i"), j.alias("j"), c.alias("category")
            )
            for n, a, b, i, j, c in parts
        ]
    )


def run_results_table(spark, sf):
    scored = fx.answers(spark, sf)
    best = evaluate.best_threshold(evaluate.threshold_sweep(scored)).select(F.lit("overall").alias("score"), "macro_f1")
    each = evaluate.macro_f1_by_question(scored).select(F.concat(F.lit("q"), F.col("q").cast("string")).alias("score"), "macro_f1")
    scores = best.unionByName(each).select("score", F.round("macro_f1", 9).alias("value"))
    path = tables.append_run_result(scores, "check", scratch_path(spark), {"folds": 5})
    return tables.read_run_results(spark, path).select("score", "value")


def oof_init_learned(spark, sf):
    rows = cleaning.assign_folds(fx.answers(spark, sf), 5)
    return chain.oof_init_learned(rows)


THIRD = {
    "exclude_listed_sessions": lambda s, sf: cleaning.exclude_listed(fx.raw_log(s, sf), (3, 5, 8)).select("session_id", "idx"),
    "exclude_sessions": exclude_sessions,
    "exclude_short_sessions": lambda s, sf: cleaning.exclude_short_sessions(
        fx.raw_log(s, sf), 15, "0-4", fx.skew(s, sf)
    ).select("session_id", "idx"),
    "sample_sessions": lambda s, sf: cleaning.restrict_to(fx.raw_log(s, sf), sample(s, sf), fx.skew(s, sf)).select(
        "session_id", "idx", "event_name"
    ),
    "sample_labels": lambda s, sf: fx.answers(s, sf).join(sample(s, sf), "session_id", "left_semi").select("label_id", "correct"),
    "scan_labels": label_file,
    "split_label_ids": lambda s, sf: cleaning.split_label_ids(label_file(s, sf), "session_id"),
    "session_time_parts": session_time_parts,
    "session_weights": lambda s, sf: stamped_sessions(s, sf).select(
        "session_id", year_weight(F.col("stamp"), (0.5, 0.8, 1.5)).alias("weight")
    ),
    "noise_features": lambda s, sf: cleaning.noise_features(fx.sessions(s, sf)),
    "assign_folds": lambda s, sf: cleaning.assign_folds(fx.sessions(s, sf), 5),
    "question_routing": lambda s, sf: chain.question_routing(fx.answers(s, sf).select("session_id", "q")),
    "oof_init": lambda s, sf: chain.oof_init(fx.sessions(s, sf)),
    "oof_init_learned": oof_init_learned,
    "labels_for_question": lambda s, sf: chain.require_labels(fx.sessions(s, sf), fx.answers(s, sf), 7),
    "question_subset": lambda s, sf: fx.answers(s, sf).where(F.col("q").isin(1, 4, 14)).select("session_id", "q", "correct", "p"),
    "truth_matrix": lambda s, sf: evaluate.truth_matrix(fx.answers(s, sf), QUESTIONS),
    "threshold_sweep": lambda s, sf: score_columns(evaluate.threshold_sweep(fx.answers(s, sf))),
    "best_threshold": lambda s, sf: score_columns(evaluate.best_threshold(evaluate.threshold_sweep(fx.answers(s, sf)))),
    "macro_f1_fixed": lambda s, sf: score_columns(evaluate.threshold_sweep(fx.answers(s, sf), [DEFAULT_THRESHOLD])),
    "macro_f1_by_question": lambda s, sf: score_columns(evaluate.macro_f1_by_question(fx.answers(s, sf))),
    "macro_f1_originals": lambda s, sf: score_columns(
        evaluate.threshold_sweep(fx.answers(s, sf).join(originals(s, sf), "session_id", "left_semi"))
    ),
    "mean_best_iterations": mean_best_iterations,
    "write_oof": written_oof,
    "csv_roundtrip": csv_roundtrip,
    "load_dictionaries": load_dictionaries,
    "run_results_table": run_results_table,
}



# --- long feature table ---------------------------------------------------------


def keep_in(spark, sf):
    return lambda name, build, of=None: written(spark, f"{sf}/features/{name}", build)


def features(spark, sf):
    """The whole feature job, its long rows and members written once."""

    @cache
    def made():
        return plan.session_features(fx.log(spark, sf), PARAMS, fx.skew(spark, sf), keep=keep_in(spark, sf))

    return plan.Features(
        written(spark, f"{sf}/features/rows", lambda: made().rows, ("level_group",)),
        written(spark, f"{sf}/features/members", lambda: made().members),
    )


def round_values(df, *columns):
    name = F.col("feature")
    plain_mean = name.contains("mean") & ~name.contains("ET_mean") & ~name.startswith("word") & ~name.startswith("elapsed")

    def rounded(c):
        return F.when(name.contains("std"), F.round(c, 2)).when(plain_mean, F.round(c, 7)).otherwise(F.round(c, 4))

    return df.withColumns({c: rounded(c) for c in columns})


def join_feature_blocks(spark, sf):
    made = plan.session_features(fx.log(spark, sf), PARAMS, fx.skew(spark, sf), keep=keep_in(spark, sf))
    return round_values(made.rows, "value")


def feature_summary(spark, sf):
    made = features(spark, sf)
    return longtable.feature_summary(made.rows, made.members, longtable.listed_counts(spark, PARAMS))


def summary(spark, sf):
    return written(spark, f"{sf}/features/all_summary", lambda: feature_summary(spark, sf))


def pruned(spark, sf):
    return written(spark, f"{sf}/features/pruned", lambda: longtable.prune(summary(spark, sf)))


def name_list(spark):
    """One list of names for each group, the groups' lists read from their own files."""
    folder = scratch_path(spark)
    for i, (group, names) in enumerate(DROPPED.items()):
        spark.createDataFrame([(json.dumps(list(names)),)], "value string").coalesce(1).write.text(f"{folder}/{i}")
    return tables.read_group_lists(spark, {group: f"{folder}/{i}" for i, group in enumerate(DROPPED)})


def cumulative_group_merge(spark, sf):
    made = features(spark, sf)
    kept = longtable.keep_features(made.rows, pruned(spark, sf))
    rows, members = longtable.merge_groups(kept, made.members, PARAMS.level_groups)
    return round_values(longtable.feature_summary(rows, members), "low", "high")


def index(spark, sf):
    """Places of the kept features in the vectors."""
    return written(spark, f"{sf}/features/index", lambda: longtable.feature_index(pruned(spark, sf)))


def feature_vectors(spark, sf):
    """Vectors of all sessions and groups."""

    def build():
        made = features(spark, sf)
        return longtable.with_vectors(longtable.sparse_cells(made.rows, made.members, index(spark, sf)), index(spark, sf))

    return remembered(spark, f"{sf}/features/vectors", build)


def fill_missing_features(spark, sf):
    """Every kept feature of every session and group, as its vectors hold it."""
    return round_values(longtable.filled_rows(feature_vectors(spark, sf), index(spark, sf)), "value")


def chain_features(spark, sf):
    """Training rows of all questions: label, number of inputs and of missing ones, scores of the questions before."""
    answers, vectors = fx.answers(spark, sf), feature_vectors(spark, sf)
    filled = longtable.filled_rows(vectors, index(spark, sf))
    counts = filled.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n_features"), F.count_if(F.col("value") == -1).alias("n_missing"))
    counts = materialised(counts)
    out = []
    for q in QUESTIONS:
        rows = chain.chain_features(counts.where(F.col("level_group") == chain.group_name(q)), answers, answers, q)
        scores = [F.round(F.col(c) * 1000).cast("int").cast("string") for c in training.score_columns(q)]
        earlier = F.concat_ws(",", *scores) if scores else F.lit("")
        out.append(rows.select("session_id", F.lit(q).alias("q"), "correct", "n_features", "n_missing", earlier.alias("earlier")))
    return longtable.stack_blocks(out)


SUPPORT = {"fqid": 0.5, "text_fqid": 0.45}


def fit_vocabulary(spark, sf):
    log = fx.log(spark, sf)
    cells = plan.value_table(log, replace(PARAMS, fitted=SUPPORT))
    return vocabulary.fit_vocabulary(cells, combos.group_sessions(log), SUPPORT)


FOURTH = {
    "join_feature_blocks": join_feature_blocks,
    "feature_summary": lambda s, sf: round_values(feature_summary(s, sf), "low", "high"),
    "prune_features": lambda s, sf: longtable.prune(summary(s, sf)).select("level_group", "block", "feature", "sessions", "present"),
    "feature_catalog": lambda s, sf: longtable.feature_catalog(summary(s, sf), pruned(s, sf)),
    "drop_listed_features": lambda s, sf: longtable.drop_listed(pruned(s, sf), name_list(s)).select(
        "level_group", "feature", "present"
    ),
    "cumulative_group_merge": cumulative_group_merge,
    "fill_missing_features": fill_missing_features,
    "chain_features": chain_features,
    "fit_vocabulary": fit_vocabulary,
}



# --- models ---------------------------------------------------------------------

# The presets but for the number of boosted trees (FIXTURES.md).
BOOSTED = models.ModelOptions(overrides={"n_estimators": 3})
EARLY = models.ModelOptions(params=BOOSTED_EARLY_STOP_PARAMS, overrides={"n_estimators": 12, "early_stopping_rounds": 2})
FOREST = models.ModelOptions(kind="forest", params=FOREST_PARAMS)
# A question with 50 trees among those with 3; scores of the questions before come from a chain.
FINAL = models.ModelOptions(params={**BOOSTED_PARAMS, "n_estimators": [50] + [3] * 17})
FOREST_CHAIN = models.ModelOptions(kind="forest", params={**FOREST_PARAMS, "n_estimators": [20]})
WEIGHTED = models.ModelOptions(overrides=BOOSTED.overrides, weights=(0.5, 0.8, 1.5))


def vectors(spark, sf):
    def build():
        selection = plan.selected_features(features(spark, sf), replace(PARAMS, time_parts=0), keep=keep_in(spark, sf))
        return training.group_tables(spark, selection, PARAMS.level_groups)

    return remembered(spark, f"{sf}/vectors", build)


def scores_given(predictions):
    """Every score once, and whether it is a probability."""
    return predictions.select("session_id", "q", F.coalesce(F.col("p").between(0, 1), F.lit(False)).alias("valid"))


def validation(options, questions=QUESTIONS):
    def run(spark, sf):
        result = training.run_validation(spark, vectors(spark, sf), fx.answers(spark, sf), options, questions)
        return scores_given(result.predictions)

    return run


# One split on one feature, on every row: what it scores can be worked out.
STUMP = {"max_depth": 1, "colsample_bytree": 1.0, "subsample": 1.0}
STUMPS = {
    "forest": models.ModelOptions(kind="forest", params={"base": {**STUMP, "bootstrap": False}, "n_estimators": [1]}),
    "boosted": models.ModelOptions(params={"base": {**STUMP, "learning_rate": 0.1}, "n_estimators": [1]}),
}


def stump_scores(spark, sf):
    """Scores of one split on a session's number of events, for all questions; the boosted ones with weights."""
    made, answers = features(spark, sf), fx.answers(spark, sf)
    places = materialised(longtable.feature_index(pruned(spark, sf).where("feature like 'session_number_grp%'")))
    rows = longtable.keep_features(made.rows, places)
    vectors = longtable.with_vectors(longtable.sparse_cells(rows, made.members, places), places)
    weight = F.when(F.col("session_id") % 3 == 0, 0.5).when(F.col("session_id") % 3 == 1, 1.0).otherwise(2.0)
    out = []
    for q in QUESTIONS:
        group = vectors.where(F.col("level_group") == chain.group_name(q)).select("session_id", "features")
        asked = group.join(chain.require_labels(group, answers, q), "session_id").withColumn("weight", weight).persist()
        for kind, options in STUMPS.items():
            model = models.fit(asked, ["features"], models.classifier(options, q, kind == "boosted"))
            out.append(models.score(model, asked).select("session_id", F.lit(q).alias("q"), F.lit(kind).alias("kind"), F.round("p", 6).alias("p")))
    return longtable.stack_blocks(out)


def train_final(spark, sf):
    labels, path = fx.answers(spark, sf), scratch_path(spark)
    groups = vectors(spark, sf)
    earlier = training.run_validation(spark, groups, labels, FOREST_CHAIN, (1,)).predictions
    training.train_final(spark, groups, labels, earlier, FINAL, path)
    return scores_given(training.score_saved(spark, path, groups, QUESTIONS, earlier))


def save_models(spark, sf):
    """Metadata of saved fold models, read back from the saved models."""
    result = training.run_validation(
        spark, vectors(spark, sf), fx.answers(spark, sf), BOOSTED, save_models=True
    )
    loaded = [(q, k, models.rounds_of(PipelineModel.load(path))) for (q, k), path in sorted(result.models.items())]
    saved = spark.createDataFrame(loaded, "q int, fold int, rounds int").join(result.rounds, ["q", "fold"])
    asked = fx.answers(spark, sf).select("q").distinct()
    return saved.join(asked, "q").select("q", "fold", (F.col("rounds") == F.col("best_iteration")).alias("same_rounds"), "rounds")


def room_cells(spark, sf):
    slotted = clicks.with_slots(clipped(spark, sf), axes(spark, sf))
    return written(spark, f"{sf}/room_cells", lambda: models.room_cells(slotted, scale(spark, sf)))


def room_axes(spark, sf):
    return written(spark, f"{sf}/room_axes", lambda: models.room_axes(room_cells(spark, sf)))


def room_grid_pca(spark, sf):
    return models.room_embedding(room_cells(spark, sf), room_axes(spark, sf))


def room_grid_variance(spark, sf):
    """Total variance of every room, and means and covariance of its embedding, which are 0."""
    room = ["level_group", "room_fqid"]
    size = lambda c: F.abs(F.round(c, 6))
    points = room_grid_pca(spark, sf).groupBy(*room).agg(
        F.count(F.lit(1)).alias("sessions"),
        size(F.avg("axis0")).alias("mean0"),
        size(F.avg("axis1")).alias("mean1"),
        size(F.covar_pop("axis0", "axis1")).alias("covariance"),
    )
    totals = room_axes(spark, sf).groupBy(*room).agg(F.round(F.max("total_variance"), 6).alias("total_variance"))
    return points.join(totals, room)


# A log of the sessions with even ids trains, one of the others is new.
NEW = replace(PARAMS, fitted=SUPPORT, time_parts=0)


def half_log(spark, sf, odd):
    """The raw log of every other session, in files of its own."""
    return written(spark, f"{sf}/half/{odd}", lambda: fx.raw_log(spark, sf).where(F.col("session_id") % 2 == odd))


def trained_half(spark, sf):
    """Place of a run saved on the training half: fitted tables and a forest for each question."""

    def build():
        path = scratch_path(spark)
        with Workspace(spark) as space:
            log = half_log(spark, sf, 0)
            prepared = space.keep("log", lambda: deltas.event_deltas(log), ("level_group",))
            made = plan.session_features(prepared, NEW, fx.skew(spark, sf), keep=space.keep)
            made.rows = space.keep("rows", lambda: made.rows, ("level_group",))
            selection = plan.selected_features(made, NEW, keep=space.keep)
            places = materialised(longtable.feature_index(selection.kept))
            groups = training.group_tables(spark, selection, NEW.level_groups, places)
            labels = fx.answers(spark, sf).where("session_id % 2 = 0")
            training.train_final(spark, groups, labels, training.starting_scores(groups), FOREST, path)
            saved_run.save_bundle(saved_run.Bundle(path, NEW, places, selection.dictionaries))
        return path

    return remembered(spark, f"{sf}/trained_half", build)


def score_new_log(spark, sf):
    """Scores of the other half of the sessions by the saved run."""
    bundle = saved_run.with_models(spark, saved_run.load_bundle(spark, trained_half(spark, sf)))
    scores = saved_run.score_log(spark, half_log(spark, sf, 1), bundle)
    return scores_given(scores)


def new_log_features(spark, sf):
    """All features of the other half as the saved run's models see them."""
    bundle = saved_run.load_bundle(spark, trained_half(spark, sf))
    made = saved_run.new_features(half_log(spark, sf, 1), bundle, Workspace(spark))
    vectors = longtable.with_vectors(longtable.sparse_cells(made.rows, made.members, bundle.index), bundle.index)
    return round_values(longtable.filled_rows(vectors, bundle.index), "value")


MODELS = {
    "score_new_log": score_new_log,
    "new_log_features": new_log_features,
    "room_grid_pca": room_grid_pca,
    "room_grid_variance": room_grid_variance,
    "oof_boosted": validation(BOOSTED),
    "oof_forest": validation(FOREST),
    "oof_boosted_early_stop": validation(EARLY),
    "oof_weighted": validation(WEIGHTED),
    "stump_scores": stump_scores,
    "train_final": train_final,
    "save_models": save_models,
}


def all_queries():
    return {**FIRST, **SECOND, **THIRD, **FOURTH, **MODELS}
