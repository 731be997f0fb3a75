"""Helpers of the text operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionweave.workspace import materialised, scratch_path, shared_folder  # noqa: F401


#: White space between words: space, tab, line feed, vertical tab, form feed, carriage return.
SPACES = " \t\n\x0b\f\r"
WORD_BREAK = "[ \\t-\\r]+"


#: Bytes of an Arrow batch between the JVM and a Python worker, unless the session sets its own.
BATCH_BYTES = 4 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
_SPARK_DEFAULT = "67108864b"


def bounded_batches(df: DataFrame) -> DataFrame:
    """``df``, after the session has been told to send its rows to Python in small batches.

    A batch is held several times over (as Arrow, as Python strings, as arrays), in
    every worker of an executor, and the text of a row is never cut.
    """
    conf = df.sparkSession.conf
    if conf.get(_BATCH_SETTING, _SPARK_DEFAULT) == _SPARK_DEFAULT:
        conf.set(_BATCH_SETTING, f"{BATCH_BYTES}b")
    return df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffled(df: DataFrame) -> DataFrame:
    """``df``, to be joined by a shuffle whatever its estimated size.

    The planner sizes a table by its compressed files, and rows that a Python function makes of it by the
    width of a row, not by their number: it would send far larger tables through the driver.
    """
    return df.hint("merge")


def words(text: Column) -> Column:
    """Words of a text as an array; none for null and for texts of white space."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), WORD_BREAK), lambda w: w != "")


def most_frequent(rows: DataFrame, count: str, most: int) -> DataFrame:
    """Rows with the greatest ``count``, at most ``most`` of them.

    The least count comes from a histogram with 16 bins per power of two; of
    ties in a bin all or none are taken. No task gets more than its own rows.
    """
    level = F.floor(F.log2(F.col(count)) * 16).cast("int")
    bins = rows.where(F.col(count) > 0).groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("n")).collect()
    taken, least = 0, None
    for r in sorted(bins, key=lambda r: -r["level"]):
        taken += r["n"]
        if taken > most:
            break
        least = r["level"]
    return rows.where(level >= least) if least is not None else rows.where(F.lit(False))


def row_key(*columns: str) -> list[Column]:
    """Two hash columns that name a row by its values (nulls allowed): rows equal in all of them share a key."""
    values = [F.col(c) for c in columns]
    return [F.xxhash64(*values).alias("_k1"), F.xxhash64(F.lit("second"), *values).alias("_k2")]
