"""Toxicity by weak supervision: many voters, a generative label model, a linear classifier.

Voters look at a whole text and fire or abstain: word lists (a fixed list and
terms learned from labelled documents, dealt to several voters) and patterns
(masked or stretched spellings, direct address, density, shouting). A latent
class model fits the rate at which every voter fires on toxic and on other
documents by expectation maximisation over the counts of vote patterns of all
documents; labelled documents keep their label. Correlations between voters that
the class does not explain are estimated from the same counts and divide the
weight of voters that repeat each other. The posterior of each pattern then labels the
training documents of a logistic regression on vote and density features, and
that scores every document.

Labels are only read of documents whose crc32(doc_id as text) mod 3 is not 1.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from sessionweave.llm.common import bounded_batches, materialised

#: Most labelled documents that terms, label model and classifier are fitted on (a hash range).
MAX_LABELLED = 10_000
#: Most terms learned from them; a term needs TERM_DOCUMENTS and a TERM_SHARE of the
#: toxic documents and an odds ratio of TERM_ODDS.
MAX_TERMS, TERM_DOCUMENTS, TERM_SHARE, TERM_ODDS = 64, 4, 0.02, 12.0
LIST_VOTERS = 8
THRESHOLD = 0.7
#: Lengths of word beginnings.
STEM = range(4, 9)

# Insults that the list voters start from.
INSULTS = {
    "en": "idiot moron stupid dumb loser scum trash worthless pathetic disgusting clown imbecile cretin bastard jerk vermin",
    "de": "idiot dummkopf trottel abschaum arschloch versager widerlich wertlos depp schwachkopf",
    "fr": "idiot imbécile crétin connard salaud ordure minable dégoûtant abruti débile",
    "es": "idiota imbécil estúpido basura escoria asqueroso inútil payaso cretino cabrón",
}
ADDRESS = frozenset("you your youre u du ihr dich tu toi vous te usted eres".split())
LEET = str.maketrans("013457@$!", "oieastasi")

FEATURES = ("hits", "distinct", "density", *(f"list_{i}" for i in range(LIST_VOTERS)), "several", "dense", "masked", "stretched", "addressed", "shouting")
VOTERS = FEATURES[3:]

_WORD = re.compile(r"[^\W_]+")
_MASKED = re.compile(r"(?<!\w)[A-Za-z@$!0-9]*[A-Za-z][@$!013457][A-Za-z][A-Za-z@$!0-9]*")
_STRETCHED = re.compile(r"(?<!\w)\w*(\w)\1\1\w*")


def stems(words: list[str]) -> list[str]:
    """Beginnings of STEM letters that two or more longer words of the list share, with a star, once per word."""
    return [f"{w[:k]}*" for w in words for k in STEM if len(w) > k]


@dataclass(frozen=True)
class Lexicon:
    """Terms and the list voter of each: whole words, and beginnings (``abc*``) that count from the second word on."""

    voter: dict[str, int] = field(default_factory=dict)

    @staticmethod
    def of(terms) -> Lexicon:
        return Lexicon({t: i % LIST_VOTERS for i, t in enumerate(sorted(set(terms)))})

    def hits(self, words: list[str]) -> list[str | None]:
        """Term of each word or None."""
        starts = {t[: min(STEM)] for t in self.voter if t.endswith("*")}
        found: list[str | None] = []
        for w in words:
            if w in self.voter:
                found.append(w)
            elif w[: min(STEM)] in starts:
                found.append(next((t for t in (f"{w[:k]}*" for k in STEM if len(w) > k) if t in self.voter), None))
            else:
                found.append(None)
        count = Counter(found)
        return [t if t and (t[-1] != "*" or count[t] > 1) else None for t in found]


def base_terms() -> set[str]:
    return {w for words in INSULTS.values() for w in words.split()}


def votes(text: str, lexicon: Lexicon) -> tuple[int, int, int, int]:
    """``votes`` (one bit per voter), ``hits``, ``distinct`` and ``n_words`` of a text."""
    voter = lexicon.voter
    words = _WORD.findall(text.lower())
    at = lexicon.hits(words)
    hits = [t for t in at if t]
    bits = 0
    for t in set(hits):
        bits |= 1 << voter[t]
    found = [len(set(hits)) >= 2, len(hits) * 60 >= len(words) and bool(hits)]
    masked = (m[0].lower().translate(LEET) for m in _MASKED.finditer(text))
    found.append(any(w in voter for w in masked))
    stretched = (re.sub(r"(.)\1+", r"\1", m[0].lower()) for m in _STRETCHED.finditer(text))
    found.append(any(w in voter for w in stretched))
    found.append(any(t and ADDRESS & set(words[max(0, i - 3) : i + 4]) for i, t in enumerate(at)))
    found.append(len(words) > 5 and text.isupper())
    for i, fired in enumerate(found):
        bits |= int(fired) << (LIST_VOTERS + i)
    return bits, len(hits), len(set(hits)), len(words)


def voted(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """``doc_id, votes, hits, distinct, n_words`` of every document, written once."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [votes(t or "", lexicon) for t in batch.column(1).to_pylist()]
            columns = [pa.array(c, pa.int32()) for c in (zip(*rows) if rows else [()] * 4)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", "votes", "hits", "distinct", "n_words"])

    spec = f"doc_id {kind}, votes int, hits int, distinct int, n_words int"
    return materialised(bounded_batches(docs).select("doc_id", "text").mapInArrow(vote, spec))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def training_labels(labels: DataFrame) -> DataFrame:
    """``doc_id, toxic`` of at most MAX_LABELLED labelled documents outside the held-out third; one label each."""
    rows = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    rows = rows.groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    rows = materialised(rows)
    share = MAX_LABELLED / max(1, rows.count())
    if share < 1:  # a hash range of nearly that share; the limit only bounds what chance adds
        place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
        rows = materialised(rows.where(place < int(0.95 * share * (1 << 30))).limit(MAX_LABELLED))
    return rows


def learned_terms(docs: DataFrame, labels: DataFrame) -> set[str]:
    """Words and repeated beginnings that mark labelled toxic documents.

    ``labels`` is bounded, so its documents are found by a broadcast. Of terms that
    begin alike only the best is taken.
    """
    sizes = {r["toxic"]: r["n"] for r in labels.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes.get(0) or not sizes.get(1):
        return set()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = Counter(), Counter()
            for toxic, text in zip(*(c.to_pylist() for c in batch.columns)):
                words = _WORD.findall((text or "").lower())
                found[toxic].update(set(words))
                found[toxic].update(t for t, n in Counter(stems(words)).items() if n > 1)
            terms = list(found[0].keys() | found[1].keys())
            columns = [pa.array(terms, pa.string()), *(pa.array([found[c][t] for t in terms], pa.int64()) for c in (1, 0))]
            yield pa.RecordBatch.from_arrays(columns, ["term", "bad", "good"])

    rows = bounded_batches(docs).select("doc_id", "text").join(F.broadcast(labels), "doc_id").select("toxic", "text")
    counted = rows.mapInArrow(count, "term string, bad long, good long").groupBy("term").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    odds = ((F.col("bad") + 0.5) / sizes[1]) / ((F.col("good") + 0.5) / sizes[0])
    share = max(TERM_DOCUMENTS, sizes[1] * TERM_SHARE)
    chosen = counted.where((F.col("bad") >= share) & (odds >= TERM_ODDS) & (F.length("term") > 2))
    best: list[str] = []
    for r in chosen.orderBy(F.desc(F.col("bad") * F.log(odds)), F.length("term"), "term").limit(20 * MAX_TERMS).collect():
        plain = r["term"].rstrip("*")
        if len(best) < MAX_TERMS and not any(plain.startswith(b.rstrip("*")) or b.rstrip("*").startswith(plain) for b in best):
            best.append(r["term"])
    return set(best)


def label_model(counts: np.ndarray, patterns: np.ndarray, labelled: np.ndarray, rounds: int = 30) -> np.ndarray:
    """Posterior of "toxic" per vote pattern.

    ``counts`` of all documents per pattern, ``patterns`` as a 0/1 matrix, ``labelled``
    counts per pattern and class. Start from the labelled rates, then EM with
    labelled documents fixed; at last every voter's weight is divided by one plus
    the correlations with other voters that remain inside the classes.
    """
    free = np.maximum(counts - labelled.sum(1), 0)
    resp = labelled.copy()
    for _ in range(rounds):
        size = resp.sum(0) + 2.0
        rate = np.clip((resp.T @ patterns + 0.5) / size[:, None], 1e-4, 1 - 1e-4)  # class x voter
        prior = np.clip(size / size.sum(), 1e-3, 1 - 1e-3)
        weight = _weights(patterns, resp, rate)
        post = _posterior(patterns, rate, prior, weight)
        resp = labelled + free[:, None] * np.stack([1 - post, post], 1)
    return post


def _weights(patterns: np.ndarray, resp: np.ndarray, rate: np.ndarray) -> np.ndarray:
    total = np.zeros((patterns.shape[1],) * 2)
    for c in (0, 1):
        centred = patterns - rate[c]
        cov = (centred * resp[:, c : c + 1]).T @ centred / max(resp[:, c].sum(), 1)
        sd = np.sqrt(np.maximum(np.diag(cov), 1e-9))
        total += np.clip(cov / np.outer(sd, sd), 0, 1) / 2
    np.fill_diagonal(total, 0)
    return 1 / (1 + total.sum(1))


def _posterior(patterns, rate, prior, weight) -> np.ndarray:
    fired = np.log(rate[1] / rate[0]) * weight
    silent = np.log((1 - rate[1]) / (1 - rate[0])) * weight
    none = (patterns.sum(1) == 0) * silent.sum()  # an abstention counts only if all abstain
    logit = np.log(prior[1] / prior[0]) + patterns @ fired + none
    return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))


def logistic_regression(x: np.ndarray, y: np.ndarray, w: np.ndarray, ridge: float = 1e-3, rounds: int = 40) -> np.ndarray:
    """Weights (the last one constant) of a ridge logistic regression on soft labels, by Newton steps."""
    x = np.hstack([x, np.ones((len(x), 1))])
    b = np.zeros(x.shape[1])
    keep = np.append(np.full(x.shape[1] - 1, ridge), 1e-6) * w.sum()
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        s = w * np.maximum(p * (1 - p), 1e-6)
        step = np.linalg.solve((x.T * s) @ x + np.diag(keep), x.T @ (w * (y - p)) - keep * b)
        b += step
        if np.abs(step).max() < 1e-6:
            break
    return b


def features(votes: Column, hits: Column, distinct: Column, n_words: Column) -> list[Column]:
    """Columns in the order of FEATURES."""
    found = [F.log1p(hits.cast("double")), F.log1p(distinct.cast("double"))]
    found.append(F.least(F.lit(1.0), 20 * hits / F.greatest(n_words, F.lit(1))))
    return found + [F.shiftright(votes, i).bitwiseAND(F.lit(1)).cast("double") for i in range(len(VOTERS))]


def fit(rows: DataFrame, labels: DataFrame) -> np.ndarray:
    """Classifier weights from votes of all documents (pattern counts) and of the labelled ones.

    The driver gets one row per vote pattern (at most 2 to the number of voters)
    with counts, and one per distinct feature row of the bounded training set.
    Without labels of both classes the fixed weights of a lone list hit are used.
    """
    all_counts = {r["votes"]: r["n"] for r in rows.groupBy("votes").agg(F.count(F.lit(1)).alias("n")).collect()}
    known = rows.join(F.broadcast(labels), "doc_id").groupBy("votes", "hits", "distinct", "n_words", "toxic").agg(F.count(F.lit(1)).alias("n")).collect()
    if len({r["toxic"] for r in known}) < 2:
        plain = np.zeros(len(FEATURES) + 1)
        plain[0], plain[-1] = 6.0, -3.0
        return plain
    order = {v: i for i, v in enumerate(sorted(all_counts))}
    labelled = np.zeros((len(order), 2))
    for r in known:
        labelled[order[r["votes"]], 1 if r["toxic"] else 0] += r["n"]
    patterns = np.array([[v >> i & 1 for i in range(len(VOTERS))] for v in order], float)
    post = label_model(np.array([all_counts[v] for v in order], float), patterns, labelled)
    x = np.array([_values(r) for r in known])
    y = np.array([post[order[r["votes"]]] for r in known])
    return logistic_regression(x, y, np.array([float(r["n"]) for r in known]))


def _values(r: Row) -> list[float]:
    first = [np.log1p(r["hits"]), np.log1p(r["distinct"]), min(1.0, 20 * r["hits"] / max(r["n_words"], 1))]
    return first + [float(r["votes"] >> i & 1) for i in range(len(VOTERS))]


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted, votes`` of every document.

    A null text is an empty one and gets the score of a text without votes. Rows
    that share a doc_id are scored each by its own text. Empty tables give empty
    results; without usable labels a list hit decides.
    """
    known = training_labels(labels)
    lexicon = Lexicon.of(base_terms() | learned_terms(docs, known))
    rows = voted(docs, lexicon)
    weights = fit(rows, known)
    columns = features(*(F.col(c) for c in ("votes", "hits", "distinct", "n_words")))
    logit = sum((F.lit(float(w)) * c for w, c in zip(weights, columns)), F.lit(float(weights[-1])))
    out = rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), (1 / (1 + F.exp(-logit))).alias("score"), "votes")
    return out.select("doc_id", "held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "votes")


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without documents that score THRESHOLD or more; a doc_id goes if one of its rows does."""
    bad = scored(docs, labels).where("predicted = 1").select(F.col("doc_id").alias("_doc")).distinct()
    bad = materialised(bad)  # few documents: their size decides how they are looked up
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["_doc"]), "left_anti")
