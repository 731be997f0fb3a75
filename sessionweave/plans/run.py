"""A whole run: load, features, validation, scores, final models."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionweave.operators import cleaning, deltas, evaluate, longtable, models
from sessionweave.operators.skew import SkewProfile, profile
from sessionweave.plans import training
from sessionweave.plans.bundle import Bundle, save_bundle
from sessionweave.plans.features import Dictionaries, Selection, log_bucket, selected_features, session_features
from sessionweave.workspace import Workspace, materialised
from sessionweave.presets import BROKEN_SESSIONS, QUESTIONS, FeatureParams
from sessionweave.sources import tables

# File names of the data set (fixed values): log, labels.
FILES = {
    "plain": ("train.parquet", "train_labels.parquet"),
    "low_mem": ("train_low_mem.parquet", "train_labels.parquet"),
    "additional": ("train_additional.parquet", "train_labels_additional.parquet"),
    "additional_grp2_3": ("train_additional_grp2_3.parquet", "train_labels_additional_grp2_3.parquet"),
}


@dataclass(frozen=True)
class LoadOptions:
    """Which files to read and which sessions to leave out.

    ``least_events`` drops sessions with fewer events in the first group;
    ``excluded`` is a CSV file with a ``session_id`` column.
    """

    variant: str = "plain"
    sampling: int | None = None
    least_events: int | None = None
    excluded: str | None = None
    seed: int = 42

    @property
    def has_originals(self) -> bool:
        return self.variant.startswith("additional")


@dataclass
class Dataset:
    log: DataFrame
    labels: DataFrame
    skew: SkewProfile
    originals: DataFrame | None = None


@dataclass(frozen=True)
class RunOptions:
    load: LoadOptions = field(default_factory=LoadOptions)
    features: FeatureParams = field(default_factory=FeatureParams)
    model: models.ModelOptions = field(default_factory=models.ModelOptions)
    merge: bool = False
    drop_list: str | dict[str, str] | None = None  # one file for all groups, or a file for each
    noise: int = 0
    oof_file: str | None = None
    zero_start: bool = False
    questions: Sequence[int] = QUESTIONS
    folds: int = 2
    seed: int = 42
    fixed_threshold: float | None = None


@dataclass
class RunResult:
    predictions: DataFrame
    best: DataFrame
    by_question: DataFrame
    rounds: DataFrame
    models: str


def load_dataset(spark: SparkSession, path: str, options: LoadOptions) -> Dataset:
    """Event log, labels as ``(session_id, q, correct)`` and, where marked, the original sessions."""
    log_file, label_file = FILES[options.variant]
    log = tables.read_event_log(spark, f"{path}/{log_file}")
    labels = cleaning.split_label_ids(tables.read_labels(spark, f"{path}/{label_file}"), "session_id")
    labels = labels.select(F.col("session").alias("session_id"), "q", "correct")

    if options.has_originals:
        log = cleaning.exclude_listed(log, BROKEN_SESSIONS)
    skew = profile(log)
    if options.least_events:
        log = cleaning.exclude_short_sessions(log, options.least_events, "0-4", skew)
    if options.excluded:
        ids = tables.read_csv(spark, options.excluded, "session_id long")
        log = cleaning.exclude_sessions(log, ids, skew)
    if options.sampling:
        chosen = cleaning.sample_sessions(log, options.sampling, options.seed)
        log = cleaning.restrict_to(log, chosen, skew)
        labels = labels.join(chosen, "session_id", "left_semi")
    originals = log.where("original = 1").select("session_id").distinct() if options.has_originals else None
    return Dataset(log, labels, skew, originals)


def make_features(
    spark: SparkSession, data: Dataset, options: RunOptions, space: Workspace, dictionaries: Dictionaries | None = None
) -> Selection:
    """Selected long features of a data set; ``dictionaries`` come from an earlier run when scoring."""
    log = space.keep("log", lambda: deltas.event_deltas(data.log, data.skew), ("level_group",), bucket_by=log_bucket(data.skew))
    made = session_features(log, options.features, data.skew, dictionaries, space.keep)
    made.rows = space.keep("rows", lambda: made.rows, ("level_group",))
    made.members = space.keep("members", lambda: made.members)
    lists = options.drop_list
    if isinstance(lists, str):
        lists = {group: lists for group in options.features.level_groups}
    drop = tables.read_group_lists(spark, lists) if lists else None
    return selected_features(made, options.features, drop, options.merge, options.noise, space.keep)


def evaluate_scores(predictions: DataFrame, data: Dataset, fixed: float | None = None) -> tuple[DataFrame, DataFrame]:
    """Best (or fixed) threshold overall, and each question's score at it; original sessions only where marked."""
    scored = predictions.join(data.labels, ["session_id", "q"])
    if data.originals is not None:
        scored = scored.join(data.originals, "session_id", "left_semi")
    thresholds = evaluate.grid() if fixed is None else [fixed]
    best = evaluate.best_threshold(evaluate.threshold_sweep(scored, thresholds))
    return best, evaluate.macro_f1_by_question(scored, thresholds)


def run(spark: SparkSession, path: str, output: str, name: str = "run", options: RunOptions | None = None) -> RunResult:
    """Everything from files to saved models; scores are appended to ``<output>/runs``.

    ``bundle.load_bundle`` reads what is saved under ``RunResult.models``, to score other logs.
    """
    options = options or RunOptions()
    space = Workspace(spark)
    data = load_dataset(spark, path, options.load)
    selection = make_features(spark, data, options, space)
    index = materialised(longtable.feature_index(selection.kept))
    groups = training.group_tables(spark, selection, options.features.level_groups, index)

    start = training.starting_scores(groups, zero=True) if options.zero_start else None
    if options.oof_file:
        start = tables.oof_rows(tables.read_oof_csv(spark, options.oof_file, QUESTIONS), QUESTIONS)
    result = training.run_validation(
        spark, groups, data.labels, options.model, options.questions, options.folds, options.seed, start, save_models=True
    )
    tables.write_oof_csv(result.predictions, f"{output}/{name}/oof_predict_proba", list(options.questions))
    mean_rounds = models.mean_best_iterations(result.rounds)
    tables.write_csv(mean_rounds, f"{output}/{name}/best_num_trees")

    asked = result.predictions.where(F.col("q").isin(list(options.questions)))
    best, by_question = evaluate_scores(asked, data, options.fixed_threshold)
    overall = best.first()
    scores = best.select(F.lit("overall").alias("score"), "macro_f1").unionByName(
        by_question.select(F.concat(F.lit("q"), F.col("q").cast("string")).alias("score"), "macro_f1")
    )
    tables.append_run_result(
        scores.withColumnRenamed("macro_f1", "value"),
        name,
        f"{output}/runs",
        {
            "folds": options.folds,
            "questions": list(options.questions),
            "kind": options.model.kind,
            "params": options.model.params,
            "ignored": models.ignored_params(models.resolve_params(options.model, options.questions[0])),
            "threshold": overall.threshold,
        },
    )

    final = options.model
    if any(models.wants_early_stop(final, q) for q in options.questions):
        # One row per question.
        final = replace(final, best_rounds={r.q: max(1, r.best_iteration) for r in mean_rounds.collect()})
    saved = training.train_final(
        spark, groups, data.labels, result.predictions, final, f"{output}/{name}/final", options.questions, overall.threshold
    )
    save_bundle(Bundle(saved, options.features, index, selection.dictionaries, options.merge, options.noise))
    return RunResult(result.predictions, best, by_question, result.rounds, saved)
