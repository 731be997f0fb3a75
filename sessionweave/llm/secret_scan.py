"""Secrets in texts: fixed patterns, and random-looking tokens found by a test battery.

A candidate token gets an encoding (hex, base32, base64, base64url or letters and
digits) and three tests of "its characters are independent and uniform over the
alphabet": chi-squared on character-class counts, a runs test on the halves of the
alphabet, and a serial correlation of neighbours. The worst of them, held against
simulated random tokens of like length and alphabet, gives its p-value. Random
tokens have p-values spread evenly, words have small ones. For every encoding and length class the counts of p-values over the
whole corpus give, for each threshold, the share of tokens above it that random
ones cannot explain; the lowest threshold at which this false-discovery estimate
stays within the limit is used. Short tokens, whose tests have little power, thus
get a stricter threshold or none at all.
"""

from __future__ import annotations

import bisect
import functools
import math
import random
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionweave.llm.common import bounded_batches, materialised

# The base patterns, in the order in which kinds are listed.
KINDS = ("assign", "access", "hex", "random")
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"

_ASSIGN = re.compile(ASSIGN, re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(ACCESS)
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")  # the runs of HEX that are long enough
_WORDS = re.compile("passw(?:or)?d|secret|token|api_?key", re.IGNORECASE | re.ASCII)
_TOKEN = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}(?:={1,2}(?![A-Za-z0-9+/_=-]))?(?![A-Za-z0-9+/_-])")

ALPHABETS = {
    "hex": "0123456789abcdef",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "alnum": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
    "base64url": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_",
}
#: p-values are counted in this many bins per encoding and length class.
BINS = 50
FDR = 0.05
#: Tokens that are added to the counts of every class: half a random token for each bin, and others that
#: grow fewer up to a p-value of 0.2. A class of few tokens leans on them, a large one outweighs them.
PRIOR = [0.5 + 0.5 * max(0, BINS // 5 - i) for i in range(BINS)]
#: Random tokens simulated per alphabet and length class.
SIMULATED = 1000

SPANS = "array<struct<kind:string,start:int,end:int>>"
FOUND = f"doc_id {{kind}}, base {SPANS}, tokens array<struct<encoding:string,size:int,bin:int,start:int,end:int>>"


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the fixed patterns by start, then kind."""
    found = []
    if _WORDS.search(text):
        found += [("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [("access", m.start(), m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [("hex", m.start(), m.end()) for m in _HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def encoding_of(token: str) -> str | None:
    """The narrowest alphabet that holds the token (padding aside); upper-case hex counts as hex."""
    body = token.rstrip("=")
    if body.isupper() and set(body) <= set("0123456789ABCDEF"):
        body = body.lower()
    return next((name for name, letters in ALPHABETS.items() if set(body) <= set(letters)), None)


def _normal_tail(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2))


def _chi2_tail(x: float, df: int) -> float:
    """Upper tail by the cube-root normal approximation."""
    if x <= 0:
        return 1.0
    c = 2 / (9 * df)
    return 0.5 * math.erfc(((x / df) ** (1 / 3) - (1 - c)) / math.sqrt(2 * c))


def uniformity(codes: list[int], size: int) -> float:
    """Chi-squared test of evenness, on single letters if there are five or more expected of each, else on wide cells."""
    n = len(codes)
    cells = min(size, max(4, n // 5))
    counts = Counter(c * cells // size for c in codes)
    widths = Counter(c * cells // size for c in range(size))
    x = sum((counts[k] - n * w / size) ** 2 / (n * w / size) for k, w in widths.items())
    return _chi2_tail(x, cells - 1)


def repeats(codes: list[int], size: int) -> float:
    """Chi-squared dispersion of single letters: words use few letters often."""
    n = len(codes)
    pairs = sum(v * (v - 1) // 2 for v in Counter(codes).values())
    mean = n * (n - 1) / 2 / size
    return _normal_tail(max(0.0, (pairs - mean) / math.sqrt(mean * (1 - 1 / size))))


def runs(codes: list[int], size: int) -> float:
    """Runs test on the two halves of the alphabet."""
    high = [c * 2 >= size for c in codes]
    a = sum(high)
    b = len(high) - a
    if not a or not b:
        return 0.0
    n = a + b
    mean, var = 1 + 2 * a * b / n, 2 * a * b * (2 * a * b - n) / (n * n * (n - 1))
    count = 1 + sum(x != y for x, y in zip(high, high[1:]))
    return _normal_tail((count - mean) / math.sqrt(var)) if var > 0 else 1.0


def serial(codes: list[int], size: int) -> float:
    """Correlation of neighbours: about normal with deviation 1/sqrt(n) for independent characters."""
    n, mean = len(codes), sum(codes) / len(codes)
    var = sum((c - mean) ** 2 for c in codes)
    if not var:
        return 0.0
    r = sum((x - mean) * (y - mean) for x, y in zip(codes, codes[1:])) / var
    return _normal_tail((r + 1 / n) * math.sqrt(n))


TESTS = (uniformity, repeats, runs, serial)


def worst(codes: list[int], size: int) -> float:
    return min(test(codes, size) for test in TESTS)


@functools.cache
def calibration(alphabet: int, length_class: int) -> list[float]:
    """Sorted worst p-values of SIMULATED random tokens (fixed seed) over ``alphabet`` letters, of the middle length of a class."""
    rng, n = random.Random(1000 * alphabet + length_class), 3 << length_class >> 1
    return sorted(worst([rng.randrange(alphabet) for _ in range(n)], alphabet) for _ in range(SIMULATED))


def length_class(n: int) -> int:
    return min(8, n.bit_length() - 1)


def randomness(token: str) -> tuple[str, float] | None:
    """Encoding of a token and the p-value of "random over its alphabet"; None if nothing fits.

    The share of random tokens of such length and alphabet whose worst test is at least as bad.
    """
    name = encoding_of(token)
    if name is None:
        return None
    body = token.rstrip("=")
    letters = ALPHABETS[name]
    codes = [letters.index(c) for c in (body.lower() if name == "hex" else body)]
    known = calibration(len(letters), length_class(len(token)))
    return name, bisect.bisect_right(known, worst(codes, len(letters))) / len(known)


def candidates(text: str, base: list[tuple[str, int, int]]) -> list[tuple]:
    """``encoding, size, bin, start, end`` of tokens outside the base spans."""
    found = []
    for m in _TOKEN.finditer(text):
        if any(s < m.end() and m.start() < e for _, s, e in base):
            continue
        tested = randomness(m[0])
        if tested:
            found.append((tested[0], length_class(m.end() - m.start()), min(BINS - 1, int(tested[1] * BINS)), m.start(), m.end()))
    return found


def scanned(docs: DataFrame) -> DataFrame:
    """``doc_id``, base spans and tested tokens of every document, written once."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
    token = pa.list_(pa.struct([("encoding", pa.string()), *((n, pa.int32()) for n in ("size", "bin", "start", "end"))]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bases, tokens = [], []
            for text in batch.column(1).to_pylist():
                base = base_spans(text or "")
                bases.append([dict(zip(("kind", "start", "end"), s)) for s in base])
                found = candidates(text or "", base)
                tokens.append([dict(zip(("encoding", "size", "bin", "start", "end"), t)) for t in found])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bases, span), pa.array(tokens, token)], ["doc_id", "base", "tokens"])

    return materialised(bounded_batches(docs).select("doc_id", "text").mapInArrow(scan, FOUND.format(kind=kind)))


def threshold(counts: list[float], fdr: float = FDR) -> int | None:
    """Lowest bin from which on false discoveries stay within ``fdr``; None if no bin does.

    Random tokens fill all bins alike, so the mean of the upper half is what they
    put into each; what a tail holds beyond is false.
    """
    upper = counts[BINS // 2 :]
    each = sum(upper) / len(upper)
    for start in range(BINS):
        tail = sum(counts[start:])
        if tail and 1 - each * (BINS - start) / tail <= fdr:
            return start
    return None


def thresholds(found: DataFrame, fdr: float = FDR) -> dict[tuple[str, int], int | None]:
    """Threshold bin of each encoding and length class from counts over all documents (at most 5 x 9 x BINS rows) and PRIOR."""
    tokens = found.select(F.explode("tokens").alias("t"))
    counted = tokens.groupBy("t.encoding", "t.size", "t.bin").count().collect()
    counts: dict[tuple[str, int], list[int]] = {}
    for r in counted:
        counts.setdefault((r["encoding"], r["size"]), [0] * BINS)[r["bin"]] += r["count"]
    return {k: threshold([n + p for n, p in zip(v, PRIOR)], fdr) for k, v in counts.items()}


def secrets(docs: DataFrame, fdr: float = FDR) -> DataFrame:
    """``doc_id, base, random``: base spans and spans of random tokens of every document (``kind, start, end``).

    Places are code points, end exclusive. A null text has no spans. Rows stay as
    they are, repeated or not; columns other than doc_id and text are ignored.
    """
    found = scanned(docs)
    limits = [(e, s, b) for (e, s), b in thresholds(found, fdr).items() if b is not None]
    limit = F.create_map(*[F.lit(x) for e, s, b in limits for x in (f"{e}/{s}", b)]) if limits else F.create_map(F.lit(""), F.lit(BINS))
    key = lambda t: F.concat(t["encoding"], F.lit("/"), t["size"].cast("string"))
    passed = F.filter("tokens", lambda t: t["bin"] >= F.coalesce(F.element_at(limit, key(t)), F.lit(BINS)))
    spans = F.transform(passed, lambda t: F.struct(F.lit("random").alias("kind"), t["start"].alias("start"), t["end"].alias("end")))
    return found.select("doc_id", "base", spans.alias("random"))


def redacted(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with every span replaced by its kind in brackets; overlapping spans become one."""
    out, at = [], 0
    for kind, start, end in sorted(spans, key=lambda s: s[1]):
        if end <= at:
            continue
        if start >= at:
            out += [text[at:start], f"[{kind}]"]
        at = end
    return "".join([*out, text[at:]])


def secret_digests(docs: DataFrame) -> DataFrame:
    """Counts of base spans per kind, the hash of their list and the list of all spans, one row per document."""
    order = F.create_map(*[F.lit(x) for i, k in enumerate(KINDS) for x in (k, i)])
    shown = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    ranked = lambda a: F.sort_array(F.transform(a, lambda s: F.struct(s["start"], order[s["kind"]], s["end"], s["kind"])))
    listed = lambda a: F.array_join(F.transform(ranked(a), lambda r: F.concat_ws(":", r["kind"], r["start"].cast("string"), r["end"].cast("string"))), ",")
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return secrets(docs).select(
        "doc_id",
        *[count(k).alias(f"n_{k}") for k in KINDS[:3]],
        F.size("random").cast("long").alias("n_random"),
        F.sha2(F.array_join(F.transform("base", shown), ","), 256).alias("base_sha256"),
        listed(F.concat("base", "random")).alias("spans"),
    )
