"""A saved run that scores other logs.

The bundle holds everything the run took from its training log: the numbering of the
features, the mined dictionaries, the fitted vocabulary, the parameters, the models and the
threshold. A new log only gives its rows.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionweave.operators import deltas
from sessionweave.operators.skew import profile
from sessionweave.plans import training
from sessionweave.plans.features import Dictionaries, Features, Selection, completed_features, log_bucket, session_features
from sessionweave.presets import FeatureParams, Milestone, Transition
from sessionweave.sources import tables
from sessionweave.workspace import Workspace

INDEX_SCHEMA = "level_group string, feature string, block string, zero boolean, index int"
VOCABULARY_SCHEMA = "level_group string, dimension string, value string, support long"


@dataclass
class Bundle:
    """A run's fitted tables and where its models are; ``merge`` and ``noise`` as they were in its features."""

    path: str
    params: FeatureParams
    index: DataFrame
    dictionaries: Dictionaries
    merge: bool = False
    noise: int = 0
    questions: tuple = ()
    threshold: float | None = None


def params_to_json(params: FeatureParams) -> str:
    return json.dumps(asdict(params))


def params_from_json(text: str) -> FeatureParams:
    def frozen(value):
        if isinstance(value, list):
            return tuple(map(frozen, value))
        return {k: frozen(v) for k, v in value.items()} if isinstance(value, dict) else value

    fields = frozen(json.loads(text))
    fields["milestones"] = tuple(Milestone(**m) for m in fields["milestones"])
    fields["transitions"] = tuple(Transition(**t) for t in fields["transitions"])
    return FeatureParams(**fields)


def save_bundle(bundle: Bundle) -> str:
    """Write the fitted tables under ``bundle.path``, beside the models that ``training.train_final`` saves there."""
    spark, fitted, path = bundle.index.sparkSession, bundle.dictionaries, bundle.path
    bundle.index.write.mode("overwrite").parquet(f"{path}/index")
    if fitted:
        tables.save_dictionaries(f"{path}/dictionaries", flr_list=fitted.flr_list, tl_list=fitted.tl_list, navigate_master=fitted.navigate_master)
    if fitted and fitted.vocabulary is not None:
        fitted.vocabulary.write.mode("overwrite").parquet(f"{path}/vocabulary")
    options = {"params": params_to_json(bundle.params), "merge": bundle.merge, "noise": bundle.noise, "dictionaries": bool(fitted)}
    spark.createDataFrame([(json.dumps(options),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/options")
    return path


def load_bundle(spark: SparkSession, path: str) -> Bundle:
    """The fitted tables of a saved run; questions and threshold are known if models were saved with it."""
    options = json.loads(spark.read.text(f"{path}/options", wholetext=True).first().value)
    params = params_from_json(options["params"])
    index = spark.read.schema(INDEX_SCHEMA).parquet(f"{path}/index")
    fitted = None
    if options["dictionaries"]:
        fitted = Dictionaries(**tables.load_dictionaries(spark, f"{path}/dictionaries"))
        if params.fitted:
            fitted.vocabulary = spark.read.schema(VOCABULARY_SCHEMA).parquet(f"{path}/vocabulary")
    return Bundle(path, params, index, fitted, options["merge"], options["noise"])


def with_models(spark: SparkSession, bundle: Bundle) -> Bundle:
    """The bundle with the questions and the threshold of its saved models."""
    # One row per question.
    rows = spark.read.parquet(f"{bundle.path}/metadata").orderBy("q").select("q", "threshold").collect()
    bundle.questions, bundle.threshold = tuple(r.q for r in rows), rows[0].threshold
    return bundle


def new_features(log: DataFrame, bundle: Bundle, space: Workspace) -> Features:
    """Long features of a new log with the bundle's dictionaries; nothing is fitted, counted or pruned on it."""
    skew = profile(log)
    prepared = space.keep("log", lambda: deltas.event_deltas(log, skew), ("level_group",), bucket_by=log_bucket(skew))
    made = session_features(prepared, bundle.params, skew, bundle.dictionaries, space.keep)
    rows, members = completed_features(made.rows, made.members, bundle.params, bundle.merge, bundle.noise)
    return Features(rows, members, bundle.dictionaries)


def new_vectors(spark: SparkSession, log: DataFrame, bundle: Bundle, space: Workspace) -> dict[str, training.GroupTable]:
    """The new log's sessions as vectors in the bundle's numbering; features it does not know are left out."""
    made = new_features(log, bundle, space)
    selection = Selection(made.rows, made.members, bundle.index, bundle.index)
    return training.group_tables(spark, selection, bundle.params.level_groups, bundle.index)


def score_log(spark: SparkSession, log: DataFrame, bundle: Bundle, space: Workspace | None = None) -> DataFrame:
    """``session_id, q, p, answer``: score of each session and question, and whether it passes the saved threshold.

    ``log`` is an event log as it is read; ``space`` must be one that holds no other log.
    """
    space = space or Workspace(spark)
    groups = new_vectors(spark, log, bundle, space)
    scores = training.score_saved(spark, bundle.path, groups, bundle.questions)
    asked = scores.where(F.col("q").isin(list(bundle.questions)))
    return asked.select("session_id", "q", "p", (F.col("p") > F.lit(float(bundle.threshold))).cast("int").alias("answer"))
