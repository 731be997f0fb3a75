"""Which tokens of one tokenizer stand for which of another: aligned documents and corpus-wide counts.

The first pass encodes every document with both tokenizers, aligns the tokens by byte
offsets and gives the distinct id pairs that overlap in it. The distinct pairs of the
corpus get a minimal perfect hash: for each bucket of pairs a row of bit arrays, in
each of which those pairs that hit a bit alone are settled, and the others go on to the
next; a pair's slot is the number of bits set before its own. Counts are dense vectors
indexed by slot, summed as a tree, and kept with the key of each slot. The second pass
aligns the stored encodings again and looks each pair up; a slot that holds
another key is an error. Beyond ``SENT_PAIRS`` distinct pairs the table is not sent to
tasks: counts are then grouped and joined by pair, with the same result.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionweave.llm.common import bounded_batches, materialised
from sessionweave.llm.fingerprints import mixed

#: Bytes of text that are encoded and aligned at a time; a longer text is taken whole.
PIECE = 1 << 18
#: Distinct pairs that a task keeps before it hands them on.
TASK_PAIRS = 1 << 20
#: Pairs to a bucket of the hash, about.
BUCKET = 1 << 15
#: Distinct pairs whose keys and counts go to every task: 8 bytes a pair (16 if ids or counts need more than 4 bytes).
SENT_PAIRS = 1 << 23
#: Bit arrays hold so many bits for each pair left; after LEVELS of them no pair is left (chance under 1e-9 a bucket).
SPREAD = 2
LEVELS = 48
#: Vectors that are summed in one step of the tree.
FAN = 32


# --- tokenizers --------------------------------------------------------------------


def _byte_of_letter() -> dict[str, int]:
    """The printable letters in which a byte-level vocabulary is written, and their bytes."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


#: How a byte-level vocabulary of this kind parts a text before it merges (fixed value).
PARTS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_tokens(spec: dict) -> list[bytes]:
    """Bytes of each id of a byte-level vocabulary file; empty for added tokens."""
    letters = _byte_of_letter()
    added = {t["id"] for t in spec.get("added_tokens", ())}
    out = [b""] * (max([*spec["model"]["vocab"].values(), *added]) + 1)
    for token, i in spec["model"]["vocab"].items():
        if i not in added:
            out[i] = bytes(letters[c] for c in token)
    return out


def piece_tokens(sp) -> list[bytes]:
    """Bytes of each id of a sentencepiece model; empty for control pieces."""
    out = []
    for i in range(sp.get_piece_size()):
        piece = sp.id_to_piece(i)
        if sp.is_control(i) or sp.is_unknown(i):
            out.append(b"")
        elif sp.is_byte(i):
            out.append(bytes([int(piece[3:5], 16)]))
        else:
            out.append(piece.replace("▁", " ").encode())
    return out


@dataclass
class Tokenizers:
    """Contents of the two vocabulary files: a byte-level BPE (A) and a sentencepiece model (B)."""

    byte_level: bytes
    pieces: bytes

    def open(self) -> _Open:
        return _Open(self)


class _Open:
    """The tokenizers in one task.

    A's merges are ranked by the ids they make, which is how its file lists them, so its
    ids come from the faster library that reads ranks; ``check_ranks`` tells whether a file allows that.
    """

    def __init__(self, files: Tokenizers):
        import sentencepiece
        import tiktoken

        self.a_bytes = byte_tokens(json.loads(files.byte_level))
        ranks = {b: i for i, b in enumerate(self.a_bytes) if b}
        self.a = tiktoken.Encoding("a", pat_str=PARTS, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_proto=files.pieces)
        self.b_bytes = piece_tokens(self.b)

    def encode(self, texts: list[str | None]) -> Iterator[tuple[list[int], list[int]]]:
        """Ids of both for each text; none where the joined bytes of either differ from space and text."""
        for text, b in zip(texts, self.b.encode([t or "" for t in texts], num_threads=1)):
            a = self.a.encode_ordinary(" " + text) if text else []
            whole = (" " + (text or "")).encode()
            if text and b"".join(map(self.a_bytes.__getitem__, a)) == whole == b"".join(map(self.b_bytes.__getitem__, b)):
                yield a, b
            else:
                yield [], []


def check_ranks(spec: dict) -> None:
    """Raise if ranks by id could merge otherwise than the file's list of merges.

    Merging a token's bytes by all lower ranks must end in the two halves that the list
    names for it. Merges within a stretch of text do not depend on what is around it as
    long as none crosses its ends, so then no other two halves can ever meet.
    """
    tokens = byte_tokens(spec)
    ids = {b: i for i, b in enumerate(tokens) if b}
    letters = _byte_of_letter()
    for merge in spec["model"]["merges"]:
        halves = [bytes(letters[c] for c in half) for half in (merge.split(" ") if isinstance(merge, str) else merge)]
        rank = ids[b"".join(halves)]
        state = [bytes([b]) for b in b"".join(halves)]
        while True:
            ranked = [(r, i) for i in range(len(state) - 1) if (r := ids.get(state[i] + state[i + 1], rank)) < rank]
            if not ranked:
                break
            _, i = min(ranked)
            state[i : i + 2] = [state[i] + state[i + 1]]
        if state != halves:
            raise ValueError(f"token {rank} is not made of its listed halves")


def read_tokenizers(byte_level: str | None = None, pieces: str | None = None) -> Tokenizers:
    """The two vocabulary files; by default the public byte-level BPE of 50,257 and the pieces of 32,000."""
    import public_tokenizers

    found = []
    for path in (byte_level or public_tokenizers.path("byte_bpe_50k.json"), pieces or public_tokenizers.path("piece_bpe_32k.model")):
        with open(path, "rb") as f:
            found.append(f.read())
    return Tokenizers(*found)


# --- alignment ---------------------------------------------------------------------


@dataclass
class Aligned:
    """Tokens of several documents put one after the other, and how they overlap.

    ``a_doc`` and ``b_doc`` give each token's document, ``a_group`` and ``b_group`` its
    group (counted over all), ``link_a``, ``link_b`` the tokens of each overlap and
    ``link_doc`` its document; ``group_doc`` is each group's document.
    """

    a: np.ndarray
    b: np.ndarray
    a_doc: np.ndarray
    b_doc: np.ndarray
    a_group: np.ndarray
    b_group: np.ndarray
    link_a: np.ndarray
    link_b: np.ndarray
    link_doc: np.ndarray
    group_doc: np.ndarray


def align(a_lists: list[np.ndarray], b_lists: list[np.ndarray], a_sizes: np.ndarray, b_sizes: np.ndarray) -> Aligned:
    """Align two encodings of the same bytes, document by document; sizes are the bytes of each id."""
    empty = np.zeros(0, np.int64)
    a = np.concatenate([empty, *a_lists]).astype(np.int64)
    b = np.concatenate([empty, *b_lists]).astype(np.int64)
    documents = np.arange(len(a_lists))
    a_doc, b_doc = np.repeat(documents, [len(x) for x in a_lists]), np.repeat(documents, [len(x) for x in b_lists])
    # Both cover the same bytes, so offsets may run on over all documents.
    a_end, b_end = np.cumsum(a_sizes[a]), np.cumsum(b_sizes[b])
    marks = np.zeros((2, int(a_end[-1]) + 1 if len(a) else 1), bool)
    marks[0, a_end] = marks[1, b_end] = True
    both = marks[0] & marks[1]
    common, cuts = np.flatnonzero(both), np.flatnonzero(marks[0] | marks[1])
    # Tokens that end before each byte offset, and groups.
    a_before, b_before, groups_before = (np.cumsum(x, dtype=np.int64) - x for x in (marks[0], marks[1], both))
    # Between two cuts lies one token of each side, and each overlapping pair has one such stretch.
    link_a, link_b = a_before[cuts], b_before[cuts]
    group_doc = a_doc[a_before[common]]
    return Aligned(a, b, a_doc, b_doc, groups_before[a_end], groups_before[b_end], link_a, link_b, a_doc[link_a], group_doc)


def pair_keys(found: Aligned, b_ids: int) -> np.ndarray:
    """Each overlap's pair of ids as one number."""
    return found.a[found.link_a] * b_ids + found.b[found.link_b]


def _width(ids: int) -> str:
    return "<u2" if ids <= 1 << 16 else "<u4"


class GroupTexts:
    """Writes ``a1,a2|b1;a3|b2,b3`` of aligned documents from a table of short strings."""

    def __init__(self, a_ids: int, b_ids: int):
        self.a, self.b = (np.array([f"{i}{s}" for s in marks for i in range(n)], "S8") for n, marks in ((a_ids, ",|"), (b_ids, ",;")))
        self.a_ids, self.b_ids = a_ids, b_ids

    def digests(self, found: Aligned, documents: int) -> list[str]:
        """SHA-256 of each document's groups; '' for a document without tokens."""
        a_last = np.append(found.a_group[1:] != found.a_group[:-1], True)[: len(found.a)]
        b_last = np.append(found.b_group[1:] != found.b_group[:-1], True)[: len(found.b)]
        # A's tokens of a group stand before B's: a token comes after those of its side and of the other side's earlier groups.
        a_at = np.arange(len(found.a)) + np.searchsorted(found.b_group, found.a_group)
        b_at = np.arange(len(found.b)) + np.searchsorted(found.a_group, found.b_group, "right")
        line = np.empty(len(found.a) + len(found.b), "S8")
        line[a_at] = self.a[found.a + self.a_ids * a_last]
        line[b_at] = self.b[found.b + self.b_ids * b_last]
        letters = line.view(np.uint8)
        used = letters != 0
        ends = np.cumsum(np.bincount(found.a_doc, minlength=documents) + np.bincount(found.b_doc, minlength=documents))
        reach = np.concatenate([[0], np.cumsum(used.reshape(-1, 8).sum(1))])[np.concatenate([[0], ends])]
        text = letters[used].tobytes()
        return [hashlib.sha256(text[i : j - 1]).hexdigest() if j > i else "" for i, j in zip(reach[:-1].tolist(), reach[1:].tolist())]


# --- minimal perfect hash ----------------------------------------------------------


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    return (mixed(keys.astype(np.uint64)) % np.uint64(buckets)).astype(np.int64)


def _place(keys: np.ndarray, level: int, size) -> np.ndarray:
    seed = np.uint64((level + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    return (mixed(keys.astype(np.uint64) + seed) % np.asarray(size, np.uint64)).astype(np.int64)


def build_bucket(keys: np.ndarray) -> tuple[list[int], np.ndarray, np.ndarray]:
    """Sizes of a bucket's bit arrays, their bits, and its keys in the order of their slots."""
    sizes, bits, placed, left = [], [], [], keys
    for level in range(LEVELS):
        if not len(left):
            break
        size = SPREAD * len(left)
        at = _place(left, level, size)
        alone = np.bincount(at, minlength=size)[at] == 1
        array = np.zeros(size, np.uint8)
        array[at[alone]] = 1
        sizes.append(size)
        bits.append(array)
        placed.append(left[alone][np.argsort(at[alone])])
        left = left[~alone]
    if len(left):
        raise ValueError("keys of a bucket are not distinct")
    return sizes, np.concatenate([np.zeros(0, np.uint8), *bits]), np.concatenate([np.zeros(0, np.int64), *placed])


class PairHash:
    """Slots of pair keys: rows ``bucket, sizes, bits`` of all buckets in one bit array."""

    def __init__(self, buckets: int, rows: list[tuple[int, list[int], bytes]]):
        self.buckets = buckets
        self.sizes = np.zeros((buckets, LEVELS), np.int64)
        counts, packed = np.zeros(buckets, np.int64), [b""] * buckets
        for bucket, sizes, bits in rows:
            self.sizes[bucket, : len(sizes)] = sizes
            counts[bucket], packed[bucket] = sum(sizes), bits
        unpacked = [np.unpackbits(np.frombuffer(p, np.uint8), count=n) for p, n in zip(packed, counts)]
        bits = np.concatenate([np.zeros(0, np.uint8), *unpacked])
        # 64 bits to a number, and the bits set before each of them.
        padded = np.zeros((len(bits) // 64 + 1) * 64, np.uint8)
        padded[: len(bits)] = bits
        self.before = np.concatenate([[0], np.cumsum(padded.reshape(-1, 64).sum(1, dtype=np.int64))])
        self.words = np.packbits(padded, bitorder="little").view("<u8")
        ends = np.cumsum(counts)
        self.starts = (ends - counts)[:, None] + np.cumsum(self.sizes, 1) - self.sizes
        #: First slot of each bucket, and the number of slots.
        self.offsets = self._set_before(np.append(ends - counts, ends[-1]))

    def _set_before(self, at: np.ndarray) -> np.ndarray:
        mask = (np.uint64(1) << (at % 64).astype(np.uint64)) - np.uint64(1)
        return self.before[at // 64] + np.bitwise_count(self.words[at // 64] & mask)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key; for a key the hash was not made of, any slot or -1."""
        out = np.full(len(keys), -1, np.int64)
        bucket = bucket_of(keys, self.buckets)
        open_ = np.arange(len(keys))
        for level in range(LEVELS):
            open_ = open_[self.sizes[bucket[open_], level] > 0]
            if not len(open_):
                break
            at = self.starts[bucket[open_], level] + _place(keys[open_], level, self.sizes[bucket[open_], level])
            hit = (self.words[at // 64] >> (at % 64).astype(np.uint64) & np.uint64(1)).astype(bool)
            out[open_[hit]] = self._set_before(at[hit])
            open_ = open_[~hit]
        return out


def pair_hash(keys: DataFrame, buckets: int) -> tuple[PairHash, DataFrame]:
    """The hash of distinct ``key`` rows, and ``bucket, keys``: each bucket's keys in the order of slots."""

    def bucketed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = bucket_of(batch.column(0).to_numpy(), buckets)
            yield pa.RecordBatch.from_arrays([pa.array(at), batch.column(0)], ["bucket", "key"])

    def build(rows: pa.Table) -> pa.Table:
        sizes, bits, ordered = build_bucket(rows["key"].to_numpy())
        return pa.table(
            {"bucket": rows["bucket"][:1], "sizes": pa.array([sizes], pa.list_(pa.int64())), "bits": [np.packbits(bits).tobytes()], "keys": [ordered.astype("<i8").tobytes()]}
        )

    built = keys.mapInArrow(bucketed, "bucket long, key long").groupBy("bucket").applyInArrow(build, "bucket long, sizes array<long>, bits binary, keys binary")
    built = materialised(built)
    rows = built.select("bucket", "sizes", "bits").toArrow()
    return PairHash(buckets, list(zip(*(rows[c].to_pylist() for c in ("bucket", "sizes", "bits"))))), built.select("bucket", "keys")


def summed_vectors(partials: DataFrame, hashed: PairHash) -> DataFrame:
    """``bucket, counts`` from rows ``key, n``: dense vectors by slot, added up as a tree of FAN vectors a step."""
    context = partials.sparkSession.sparkContext
    shared = context.broadcast(hashed)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        found, offsets = {}, shared.value.offsets
        for batch in batches:
            keys, n = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            slots, bucket = shared.value.slots(keys), bucket_of(keys, shared.value.buckets)
            order = np.argsort(bucket, kind="stable")
            edges = np.flatnonzero(np.diff(bucket[order], prepend=-1, append=-1))
            for i, j in zip(edges[:-1], edges[1:]):
                at, k = order[i:j], int(bucket[order[i]])
                if k not in found:
                    found[k] = np.zeros(offsets[k + 1] - offsets[k], np.int64)
                np.add.at(found[k], slots[at] - offsets[k], n[at])
        part = TaskContext.get().partitionId()
        for k, v in found.items():
            yield pa.RecordBatch.from_pydict({"bucket": [k], "part": [part], "counts": [v.astype("<i8").tobytes()]})

    def add(rows: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(v, "<i8") for v in rows["counts"].to_pylist())
        return pa.table({"bucket": rows["bucket"][:1], "part": rows["part"][:1], "counts": [total.astype("<i8").tobytes()]})

    schema = "bucket long, part long, counts binary"
    out, parts = partials.mapInArrow(vectors, schema), partials.rdd.getNumPartitions()
    while parts > 1:
        out = out.withColumn("part", F.floor(F.col("part") / FAN)).groupBy("bucket", "part").applyInArrow(add, schema)
        parts = -(-parts // FAN)
    return out.select("bucket", "counts")


@dataclass
class PairCounts:
    """What a task looks pairs up in: the hash, and by slot the key, its count and whether it is the best of its A id."""

    hashed: PairHash
    keys: np.ndarray
    counts: np.ndarray
    best: np.ndarray

    def look_up(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        slots = self.hashed.slots(keys)
        if not np.array_equal(self.keys[slots], keys):
            raise ValueError("a pair is not in the table")
        return self.counts[slots], self.best[slots]


def _narrow(values: np.ndarray) -> np.ndarray:
    return values.astype(np.uint32) if not len(values) or values.max() < 1 << 32 else values


# --- documents ---------------------------------------------------------------------


def encodings(docs: DataFrame, tokenizers: Tokenizers) -> DataFrame:
    """``doc_id, a, b`` of every row: the ids of both tokenizers as packed numbers, empty where a document has no tokens."""
    shared = docs.sparkSession.sparkContext.broadcast(tokenizers)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened = shared.value.open()
        a_kind, b_kind = _width(len(opened.a_bytes)), _width(len(opened.b_bytes))
        for batch in batches:
            pairs = opened.encode(batch.column(1).to_pylist())
            packed = [(np.array(a, a_kind).tobytes(), np.array(b, b_kind).tobytes()) for a, b in pairs]
            columns = [batch.column(0), pa.array([a for a, _ in packed], pa.binary()), pa.array([b for _, b in packed], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "a", "b"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return bounded_batches(docs).select("doc_id", "text").mapInArrow(encode, f"doc_id {kind}, a binary, b binary")


@dataclass
class _Sizes:
    """Bytes of each id of both tokenizers."""

    a: np.ndarray
    b: np.ndarray

    @classmethod
    def of(cls, tokenizers: Tokenizers) -> _Sizes:
        opened = tokenizers.open()
        return cls(*(np.array([len(t) for t in tokens], np.int64) for tokens in (opened.a_bytes, opened.b_bytes)))

    def pieces(self, batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, int, Aligned]]:
        """Runs of a batch's documents, PIECE bytes of ids at a time, aligned."""
        a, b = batch.column(column).to_pylist(), batch.column(column + 1).to_pylist()
        first = size = 0
        for i in range(len(a)):
            size += len(a[i])
            if size >= PIECE or i == len(a) - 1:
                lists = [[np.frombuffer(x, _width(len(s))) for x in ids[first : i + 1]] for ids, s in ((a, self.a), (b, self.b))]
                yield first, i + 1, align(*lists, self.a, self.b)
                first, size = i + 1, 0


def partial_counts(encoded: DataFrame, sizes: _Sizes) -> DataFrame:
    """``key, n``: documents that hold an id pair linked, counted in each task."""
    shared = encoded.sparkSession.sparkContext.broadcast(sizes)

    def summed(found):
        keys, at = np.unique(np.concatenate([k for k, _ in found]), return_inverse=True)
        return keys, np.bincount(at, np.concatenate([n for _, n in found])).astype(np.int64)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = shared.value
        pairs = len(sizes.a) * len(sizes.b)
        found, held = [], 0
        for batch in batches:
            for _, _, aligned in sizes.pieces(batch, 0):
                once = np.unique(aligned.link_doc * pairs + pair_keys(aligned, len(sizes.b))) % pairs
                keys, n = np.unique(once, return_counts=True)
                found.append((keys, n))
                held += len(keys)
                if held > TASK_PAIRS:
                    found = [summed(found)]
                    held = len(found[0][0])
                    if held > TASK_PAIRS // 2:
                        yield pa.RecordBatch.from_arrays([*map(pa.array, found[0])], ["key", "n"])
                        found, held = [], 0
        if found:
            yield pa.RecordBatch.from_arrays([*map(pa.array, summed(found))], ["key", "n"])

    return encoded.select("a", "b").mapInArrow(count, "key long, n long")


def sent_counts(partials: DataFrame, distinct: DataFrame, pairs: int, b_ids: int) -> PairCounts:
    """The table of pairs for the tasks: at most SENT_PAIRS of them."""
    hashed, keys = pair_hash(distinct, max(1, -(-pairs // BUCKET)))
    counts = summed_vectors(partials, hashed)
    rows = keys.join(counts, "bucket").select("bucket", "keys", "counts").toArrow().sort_by("bucket")
    key, n = (np.concatenate([np.zeros(0, np.int64), *(np.frombuffer(x, "<i8") for x in rows[c].to_pylist())]) for c in ("keys", "counts"))
    highest = np.zeros(int(key.max() // b_ids) + 1 if len(key) else 1, np.int64)
    np.maximum.at(highest, key // b_ids, n)
    return PairCounts(hashed, _narrow(key), _narrow(n), n == highest[key // b_ids])


def _result(encoded: DataFrame, sizes: _Sizes, look_up) -> DataFrame:
    """Rows per document; with ``look_up`` (a broadcast of PairCounts) with counts, else with the ``links`` ``(key, times)``."""
    context = encoded.sparkSession.sparkContext
    shared = context.broadcast(sizes)
    kind = encoded.schema["doc_id"].dataType.simpleString()
    plain = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    pair = pa.struct([("key", pa.int64()), ("times", pa.int64())])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = shared.value
        texts = GroupTexts(len(sizes.a), len(sizes.b))
        for batch in batches:
            for first, last, aligned in sizes.pieces(batch, 1):
                documents = last - first
                per_doc = [np.bincount(x, minlength=documents) for x in (aligned.a_doc, aligned.b_doc, aligned.group_doc, aligned.link_doc)]
                columns = [batch.column(0)[first:last], *map(pa.array, per_doc), pa.array(texts.digests(aligned, documents), pa.string())]
                keys = pair_keys(aligned, len(sizes.b))
                if look_up is not None:
                    distinct, at = np.unique(keys, return_inverse=True)
                    counts, best = look_up.value.look_up(distinct)
                    sums = np.zeros(documents, np.int64)
                    np.add.at(sums, aligned.link_doc, counts.astype(np.int64)[at])
                    columns += [pa.array(np.bincount(aligned.link_doc[best[at]], minlength=documents)), pa.array(sums)]
                    yield pa.RecordBatch.from_arrays(columns, [*plain, "n_best", "count_sum"])
                else:
                    ends = np.cumsum(per_doc[3])
                    lists = []
                    for i, j in zip(ends - per_doc[3], ends):
                        found, times = np.unique(keys[i:j], return_counts=True)
                        lists.append([{"key": k, "times": t} for k, t in zip(found.tolist(), times.tolist())])
                    yield pa.RecordBatch.from_arrays([*columns, pa.array(lists, pa.list_(pair))], [*plain, "links"])

    schema = f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    schema += "n_best long, count_sum long" if look_up is not None else "links array<struct<key:long,times:long>>"
    return encoded.select("doc_id", "a", "b").mapInArrow(measure, schema)


def _joined(encoded: DataFrame, sizes: _Sizes, partials: DataFrame) -> DataFrame:
    """The result with pairs counted by grouping and looked up by joins, for any number of pairs."""
    counts = partials.groupBy("key").agg(F.sum("n").alias("n")).withColumn("a_id", F.floor(F.col("key") / len(sizes.b)))
    highest = counts.groupBy("a_id").agg(F.max("n").alias("highest"))
    counts = materialised(counts.join(highest, "a_id").select("key", "n", (F.col("n") == F.col("highest")).alias("best")))
    rows = materialised(_result(encoded, sizes, None).withColumn("row", F.monotonically_increasing_id()))
    links = rows.select("row", F.explode("links").alias("link")).select("row", "link.key", "link.times")
    found = links.join(counts, "key").groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum")
    )
    return rows.drop("links").join(found, "row", "left").drop("row").fillna(0, ["n_best", "count_sum"])


def linked_tokens(docs: DataFrame, tokenizers: Tokenizers, most: int = SENT_PAIRS) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` of every row of ``docs``.

    Null and empty texts, and texts that one of the tokenizers changes, have no tokens: zeros and
    an empty digest. A repeated row counts as another document; other columns are ignored;
    an empty table gives an empty result. ``most`` is the number of distinct pairs up to which their table is sent to the tasks.
    """
    encoded = materialised(encodings(docs, tokenizers))
    sizes = _Sizes.of(tokenizers)
    partials = materialised(partial_counts(encoded, sizes))
    distinct = materialised(partials.select("key").distinct())
    pairs = distinct.count()
    if pairs > most:
        out = _joined(encoded, sizes, partials)
    else:
        table = sent_counts(partials, distinct, pairs, len(sizes.b))
        out = _result(encoded, sizes, docs.sparkSession.sparkContext.broadcast(table))
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
