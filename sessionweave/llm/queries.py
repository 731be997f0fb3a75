"""Registered queries of the text operators: each over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionweave.llm.common import table
from sessionweave.llm.decontaminate import contaminated
from sessionweave.llm.html_text import extracted
from sessionweave.llm.line_dedup import deduplicated
from sessionweave.llm.ngram_join import near_duplicates
from sessionweave.llm.quality_rules import quality
from sessionweave.llm.secret_scan import secret_digests
from sessionweave.llm.sentencepiece_codec import encoded, read_model
from sessionweave.llm.sharding import document_shards
from sessionweave.llm.spelling import spelling_variants
from sessionweave.llm.tokenizer_links import linked_tokens, read_tokenizers
from sessionweave.llm.topk_search import nearest
from sessionweave.llm.toxicity import scored
from sessionweave.llm.warc import archive_pages


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = deduplicated(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "text", "n_removed", "share_left")


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_shards(table(spark, sf_dir, "documents"))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_pages(table(spark, sf_dir, "pages"))


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded(table(spark, sf_dir, "documents"), read_model(), digests=True)


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_digests(table(spark, sf_dir, "documents"))


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extracted(table(spark, sf_dir, "pages"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"))


def op11_tokenizer_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linked_tokens(table(spark, sf_dir, "documents"), read_tokenizers())


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"))


def op13_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, 20)


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    every = (
        op1_line_dedup,
        op2_ngram_join,
        op3_sharding,
        op4_decontaminate,
        op5_warc,
        op6_sentencepiece,
        op7_secret_scan,
        op8_html_text,
        op9_toxicity,
        op10_quality_rules,
        op11_tokenizer_links,
        op12_spelling_variants,
        op13_topk_search,
    )
    return {f.__name__: f for f in every}


def llm_oracles() -> dict[str, str]:
    from sessionweave.llm.oracles import ORACLES

    return dict(ORACLES)
