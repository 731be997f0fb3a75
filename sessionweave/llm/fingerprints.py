"""Hashes of words and word shingles of whole Arrow columns with numpy.

Words are runs of bytes other than space, tab, line feed, vertical tab, form feed
and carriage return; A-Z count as a-z. A word's hash is a polynomial over random
64-bit letters, mixed; a shingle's hash is a polynomial over its words, mixed.
Two different shingles share a hash with a chance of about 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

K = 5
#: Bytes of text that are hashed at a time (a longer text is taken whole).
PIECE = 1 << 18

_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
#: White space and ASCII punctuation: words are then letters, digits and other characters.
PUNCTUATION = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
_LETTER = np.random.Generator(np.random.PCG64(20240607)).integers(1, 1 << 64, 256, dtype=np.uint64, endpoint=False)
_LETTER[65:91] = _LETTER[97:123]
_BASE = 0x9E3779B97F4A7C15
_STEP = np.uint64(0xD6E8FEB86659FD93)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up = np.full(n, _BASE, np.uint64)
    down = np.full(n, pow(_BASE, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


_CACHE: dict[str, tuple[np.ndarray, np.ndarray]] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least ``n`` of each."""
    if "p" not in _CACHE or len(_CACHE["p"][0]) < n:
        _CACHE["p"] = _powers(max(n, 2 * PIECE))
    return _CACHE["p"]


def mixed(h: np.ndarray) -> np.ndarray:
    """Bits of each value spread over all 64."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def _pieces(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Bytes and text offsets of runs of texts of about PIECE bytes."""
    column = texts.fill_null("").cast(pa.large_string())
    if len(column) == 0:
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1 + column.offset)[column.offset :]
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + PIECE, "right")) - 1)
        yield data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def word_hashes(data: np.ndarray, offsets: np.ndarray, breaks: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, and the index of the first word of each text (one more at the end); ``breaks`` part words."""
    n = len(data)
    if n == 0:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    space = breaks[data]
    before, after = np.empty(n, bool), np.empty(n, bool)
    before[0] = after[-1] = True
    before[1:], after[:-1] = space[:-1], space[1:]
    inner = offsets[(offsets > 0) & (offsets < n)]
    before[inner] = True
    after[inner - 1] = True
    starts, ends = np.flatnonzero(~space & before), np.flatnonzero(~space & after)
    up, down = powers(n)
    total = np.cumsum(_LETTER[data] * up[:n], dtype=np.uint64)
    left = np.where(starts > 0, total[starts - 1], np.uint64(0))
    words = mixed((total[ends] - left) * down[starts])
    return words, np.searchsorted(starts, offsets)


def shingled(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of the ``k`` words from each position on."""
    out = np.zeros(max(0, len(words) - k + 1), np.uint64)
    for j in range(k):
        out = out * _STEP + words[j : j + len(out)]
    return mixed(out)


def word_pieces(texts: pa.Array, breaks: np.ndarray = _SPACE) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Word hashes of runs of texts, and the index of each text's first word (one more at the end)."""
    for data, offsets in _pieces(texts):
        yield word_hashes(data, offsets, breaks)


def word_lists(texts: pa.Array, breaks: np.ndarray = _SPACE) -> Iterator[np.ndarray]:
    """Word hashes of each text in order."""
    for data, offsets in _pieces(texts):
        words, first = word_hashes(data, offsets, breaks)
        for a, b in zip(first[:-1], first[1:]):
            yield words[a:b]


def shingle_lists(texts: pa.Array, k: int = K) -> Iterator[np.ndarray]:
    """For each text the hashes of its ``k``-word shingles in order; with fewer words one hash of all; none without words."""
    for data, offsets in _pieces(texts):
        words, first = word_hashes(data, offsets)
        every = shingled(words, k)
        for a, b in zip(first[:-1], first[1:]):
            if b - a >= k:
                yield every[a : b - k + 1]
            elif b > a:
                h = np.uint64(b - a)
                with np.errstate(over="ignore"):
                    for w in words[a:b]:
                        h = h * _STEP + w
                yield mixed(np.array([h], np.uint64) + np.uint64(1))
            else:
                yield np.zeros(0, np.uint64)


def shingle_sets(texts: pa.Array, k: int = K) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text, as signed 64-bit numbers."""
    for hashes in shingle_lists(texts, k):
        yield np.unique(hashes.view(np.int64))
