"""From raw documents to token ids: five stages, each written and read again.

Every stage but the last returns the columns of ``documents``; what a stage drops or
cuts is gone for the next one. ``run`` gives per document ``doc_id, n_tokens,
ids_sha256, decoded_sha256``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sessionweave.llm.common import materialised, table
from sessionweave.llm.decontaminate import without_benchmark
from sessionweave.llm.line_dedup import without_repeats
from sessionweave.llm.ngram_join import without_near_duplicates
from sessionweave.llm.sentencepiece_codec import encoded, read_model
from sessionweave.llm.toxicity import without_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go."""
    return without_toxic(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated passages are cut out of all but their first document; copies that lose every word go."""
    return without_repeats(docs)


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return without_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold an item of the benchmark go."""
    return without_benchmark(docs, table(spark, sf_dir, "benchmark"))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document that is left, as digests."""
    return encoded(docs, read_model(), digests=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("ngram_jaccard", ngram_jaccard),
    ("decontamination", decontamination),
    ("sentencepiece", sentencepiece),
]

#: Label model, passages and subword ids are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = materialised(stage(spark, docs, sf_dir))
    return docs
