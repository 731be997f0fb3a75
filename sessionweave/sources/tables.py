"""Files in and out: event logs, labels, dictionaries, predictions, run results."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionweave.operators import longtable

UNUSED = ("fullscreen", "hq", "music")

FQID_COMBO_SCHEMA = "level_group string, fqid string, level int, room_fqid string"
TEXT_COMBO_SCHEMA = "level_group string, text_fqid string, level int"
NAVIGATE_SCHEMA = "level_group string, room_fqid string, room_x bigint, room_y bigint, category int"
DICTIONARIES = {"flr_list": FQID_COMBO_SCHEMA, "tl_list": TEXT_COMBO_SCHEMA, "navigate_master": NAVIGATE_SCHEMA}


def read_event_log(spark: SparkSession, path: str) -> DataFrame:
    """Parquet log without the unused columns; dictionary-typed text comes back as text."""
    log = spark.read.parquet(path).drop(*UNUSED)
    return log.withColumnsRenamed({"index": "idx"})


def read_labels(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_csv(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """CSV with a header; give the schema to read it in one pass."""
    reader = spark.read.option("header", True)
    return reader.csv(path, schema=schema) if schema else reader.option("inferSchema", True).csv(path)


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> str:
    df.write.mode(mode).option("header", True).csv(path)
    return path


def save_dictionaries(path: str, **tables: DataFrame) -> None:
    """Write fitted dictionaries (``flr_list``, ``tl_list``, ``navigate_master``) as CSV."""
    for name, df in tables.items():
        columns = [part.split()[0] for part in DICTIONARIES[name].split(", ")]
        write_csv(df.select(*columns), f"{path}/{name}", "overwrite")


def load_dictionaries(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    return {name: read_csv(spark, f"{path}/{name}", schema) for name, schema in DICTIONARIES.items()}


def read_name_list(spark: SparkSession, path: str) -> DataFrame:
    """A JSON array of feature names as a one-column table."""
    text = spark.read.text(path, wholetext=True)
    return text.select(F.explode(F.from_json("value", "array<string>")).alias("feature"))


def read_group_lists(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Name lists of several groups as ``(level_group, feature)``; names that changed are given as they are now."""
    lists = [read_name_list(spark, path).select(F.lit(group).alias("level_group"), "feature") for group, path in paths.items()]
    return longtable.current_names(longtable.stack_blocks(lists))


def read_params(spark: SparkSession, path: str) -> dict:
    """A JSON parameter file: a handful of numbers, read on the driver."""
    return json.loads(spark.read.text(path, wholetext=True).first().value)


def read_question_params(spark: SparkSession, folder: str) -> dict[int, dict]:
    """Parameter files ``q<number>.json`` of a folder by question; questions without one are left out."""
    files = spark.read.option("pathGlobFilter", "q*.json").text(folder, wholetext=True)
    number = F.regexp_extract("_metadata.file_name", "^q([0-9]+)[.]json$", 1).cast("int")
    return {row.q: json.loads(row.value) for row in files.select(number.alias("q"), "value").collect()}


# --- predictions --------------------------------------------------------------


def write_oof(predictions: DataFrame, path: str) -> str:
    """Predictions ``(session_id, q, p)``, one file set per question."""
    predictions.select("session_id", "q", "p").write.partitionBy("q").parquet(path)
    return path


def read_oof(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("session_id long, p double, q int").parquet(path).select("session_id", "q", "p")


def write_oof_csv(predictions: DataFrame, path: str, questions) -> str:
    """Wide CSV with columns ``0 .. n-1``, column ``t - 1`` for question t."""
    wide = predictions.groupBy("session_id").pivot("q", list(questions)).agg(F.max("p"))
    columns = [F.col(str(q)).alias(str(q - 1)) for q in questions]
    return write_csv(wide.select("session_id", *columns), path)


def read_oof_csv(spark: SparkSession, path: str, questions) -> DataFrame:
    """The wide CSV; ``oof_rows`` turns it into one row per question."""
    schema = "session_id bigint, " + ", ".join(f"`{q - 1}` double" for q in questions)
    return read_csv(spark, path, schema)


def oof_rows(wide: DataFrame, questions) -> DataFrame:
    rows = wide.unpivot(["session_id"], [str(q - 1) for q in questions], "column", "p")
    return rows.select("session_id", (F.col("column").cast("int") + 1).alias("q"), "p")


# --- run results --------------------------------------------------------------


def append_run_result(scores: DataFrame, run: str, path: str, options: dict | None = None) -> str:
    """Append one run's scores ``(score, value)`` with its options to a Parquet table."""
    row = scores.select(
        F.lit(run).alias("run"),
        F.current_timestamp().alias("at"),
        F.lit(json.dumps(options or {}, sort_keys=True)).alias("options"),
        "score",
        "value",
    )
    row.coalesce(1).write.mode("append").parquet(path)
    return path


def read_run_results(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
