"""Cross-document line frequency as a quality rule, with base counts of each document.

Lines are normalised (lower case, digits to 0, white space and punctuation
squeezed) and hashed; for every host (``source``) the number of distinct
documents that hold a line is counted. A line above the limit of its host is
boilerplate and goes; a document that loses too much of its words is rejected.
All of it is DataFrame work.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionweave.llm.common import SPACES, materialised, row_key, words

SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class LineLimits:
    """A line is boilerplate if at least ``documents`` documents and more than ``share`` of a host's documents hold it,
    or ``most`` documents, whatever the host's size."""

    documents: int = 10
    share: float = 0.06
    most: int = 1000
    #: A document is depleted if less than this share of its words is left, or fewer words than ``least_words``.
    left: float = 0.5
    least_words: int = 30


def _without(text: Column, letters: str) -> Column:
    return F.translate(text, letters, "")


def _windows(w: Column) -> Column:
    """Hash and position of every 3-word window, sorted: equal windows are neighbours."""
    heads = F.slice(w, 1, F.greatest(F.size(w) - 2, F.lit(0)))
    return F.sort_array(
        F.transform(heads, lambda x, i: F.struct(F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("i")))
    )


def _covered(windows: Column) -> Column:
    """Word positions in windows that have an equal neighbour, each once; n log n for any text."""
    at = lambda i: F.get(windows, i)["h"]
    twice = F.filter(windows, lambda x, i: x["h"].eqNullSafe(at(i - 1)) | x["h"].eqNullSafe(at(i + 1)))
    spread = F.flatten(F.transform(twice, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))
    return F.size(F.array_distinct(spread)).cast("long")


def base_counts(text: Column, w: Column) -> dict[str, Column]:
    """Counts that need the text ``text`` (not null) and its words ``w`` only."""
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.trim(F.translate(x, SPACES, " "))) > 0)
    return {
        "n_words": F.size(w).cast("long"),
        "word_chars": F.length(_without(text, SPACES)).cast("long"),
        "n_symbols": (F.length(text) - F.length(_without(text, SYMBOLS))).cast("long"),
        "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
    }


def normalised(line: Column) -> Column:
    """Lower case, digits as 0, everything else than letters and digits as one space, trimmed."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(line), "[0-9]+", "0"), "[^\\p{L}\\p{M}0]+", " "))


def document_lines(docs: DataFrame) -> DataFrame:
    """``_k1, _k2, source, line`` (hash of the normalised line), ``line_words``: one row per distinct line of a document.

    Lines without a letter or digit have no hash and are not counted.
    ``line_words`` has the words of all the line's occurrences in the document.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = docs.select(*row_key("doc_id", "text"), "source", F.explode(F.split(text, "\n")).alias("_line"))
    lines = lines.withColumn("_plain", normalised(F.col("_line"))).where("_plain <> ''")
    lines = lines.select("_k1", "_k2", "source", F.xxhash64("_plain").alias("line"), F.size(words(F.col("_line"))).alias("_n"))
    return lines.groupBy("_k1", "_k2", "source", "line").agg(F.sum("_n").alias("line_words"))


def boilerplate_lines(lines: DataFrame, hosts: DataFrame, limits: LineLimits) -> DataFrame:
    """``source, line, documents`` of lines above the limits of their host.

    ``hosts`` has ``source, host_documents``; a null source is a host of its own.
    Counts are combined before they move, so a line of millions of documents is one row per task.
    """
    counted = lines.groupBy("source", "line").agg(F.count(F.lit(1)).alias("documents"))
    counted = counted.where(F.col("documents") >= limits.documents).alias("c")
    same = F.col("c.source").eqNullSafe(F.col("h.source"))
    many = (F.col("documents") > F.lit(limits.share) * F.col("host_documents")) | (F.col("documents") >= limits.most)
    return counted.join(hosts.alias("h"), same & many).select("c.source", "line", "documents")


def quality(docs: DataFrame, limits: LineLimits = LineLimits()) -> DataFrame:
    """Counts and verdict of every document of ``docs`` (``doc_id, text, source``; further columns are ignored).

    Returns ``doc_id``, the base counts, ``base_failed``, ``words_removed`` (words
    in boilerplate lines), ``depleted`` and ``kept``. A null text has no words and
    fails the base rule. Rows with equal doc_id and text are one document and get
    one row each, with the same values. An empty table gives an empty result.
    """
    lines = materialised(document_lines(docs))
    one_each = docs.select(*row_key("doc_id", "text"), "source").distinct()
    hosts = one_each.groupBy("source").agg(F.count(F.lit(1)).alias("host_documents"))
    common = boilerplate_lines(lines, hosts, limits).alias("b")
    same = (F.col("l.line") == F.col("b.line")) & F.col("l.source").eqNullSafe(F.col("b.source"))
    removed = lines.alias("l").join(common, same, "left_semi")
    removed = removed.groupBy("_k1", "_k2").agg(F.sum("line_words").alias("_removed"))

    text = F.coalesce(F.col("text"), F.lit(""))
    one = docs.select("doc_id", *row_key("doc_id", "text"), text.alias("text"), words(text).alias("_w"))
    one = one.withColumn("_windows", _windows(F.col("_w")))
    counts = base_counts(F.col("text"), F.col("_w")) | {"n_repeat_words": _covered(F.col("_windows"))}
    rows = one.select("doc_id", "_k1", "_k2", *[v.alias(k) for k, v in counts.items()])
    rows = rows.join(removed, ["_k1", "_k2"], "left")
    gone = F.least(F.coalesce("_removed", F.lit(0)), F.col("n_words"))
    left = F.col("n_words") - F.col("words_removed")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    rows = rows.withColumns({"words_removed": gone, "base_failed": failed})
    lost = (left < F.lit(limits.left) * F.col("n_words")) | ((F.col("words_removed") > 0) & (left < limits.least_words))
    rows = rows.withColumn("depleted", lost)
    return rows.select("doc_id", *counts, "base_failed", "words_removed", "depleted", (~F.col("base_failed") & ~F.col("depleted")).alias("kept"))


def without_boilerplate(docs: DataFrame, limits: LineLimits = LineLimits()) -> DataFrame:
    """``docs`` of kept documents, their boilerplate lines taken out of ``text``; every other column as it is."""
    lines = materialised(document_lines(docs))
    one_each = docs.select(*row_key("doc_id", "text"), "source").distinct()
    hosts = one_each.groupBy("source").agg(F.count(F.lit(1)).alias("host_documents"))
    common = boilerplate_lines(lines, hosts, limits).alias("b")
    same = (F.col("l.line") == F.col("b.line")) & F.col("l.source").eqNullSafe(F.col("b.source"))
    hit = lines.alias("l").join(common, same, "left_semi")
    hit = hit.groupBy("_k1", "_k2").agg(F.collect_set("line").alias("_lines"))  # at most a document's own lines
    verdict = quality(docs, limits).select("doc_id", "kept")
    keyed = docs.select("*", *row_key("doc_id", "text")).join(hit, ["_k1", "_k2"], "left")
    line_hash = lambda x: F.xxhash64(normalised(x))
    rest = F.filter(F.split("text", "\n"), lambda x: ~F.array_contains("_lines", line_hash(x)))
    cut = keyed.withColumn("text", F.when(F.col("_lines").isNull(), F.col("text")).otherwise(F.array_join(rest, "\n")))
    good = verdict.where("kept").select(F.col("doc_id").alias("_doc")).distinct()
    return cut.join(good, cut["doc_id"].eqNullSafe(good["_doc"]), "left_semi").select(*docs.columns)
