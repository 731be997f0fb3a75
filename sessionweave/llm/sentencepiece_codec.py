"""SentencePiece encoding and decoding over a table of distinct chunks.

In the vocabulary no piece has a white-space marker after another character, so
no merge crosses the start of a marked word: a text is the sequence of its
chunks (a run of markers with the characters up to the next run), and its ids are
the ids of its chunks in order. ``chunk_table`` counts the distinct chunks of the
corpus and segments the most frequent ones once (a fixed number of short chunks,
so a fixed size). These rows are sent to every task, and ids are joined back by
position there. A chunk beyond them is segmented where it stands,
once per task: moving every occurrence of a rare chunk to its row and back would
move the whole corpus twice.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionweave.llm.common import bounded_batches, materialised, most_frequent

MARK = "▁"
#: Rows of the chunk table that every task gets, and the longest chunk among them: at most about 10 MB.
HEAD_ROWS = 1 << 16
LONGEST = 32
#: Distinct chunks a task keeps before it lets them go.
TASK_ROWS = 150_000

_CHUNK = re.compile(" +[^ ]*")


def chunks(text: str) -> list[str]:
    """Marked words of a text, markers as spaces, with the marker that encoding puts in front."""
    return _CHUNK.findall(" " + text.replace(MARK, " ")) if text else []


def processor(model: bytes):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_proto=model)


def check_vocabulary(model: bytes) -> None:
    """Raise if a piece could cross the start of a marked word, or if white space is changed before encoding."""
    sp = processor(model)
    for i in range(sp.get_piece_size()):
        if re.search(f"[^{MARK}]{MARK}", sp.id_to_piece(i)):
            raise ValueError(f"piece {i} crosses a marked word")
    if sp.decode(sp.encode(" a  b ")) != " a  b ":
        raise ValueError("the model changes white space")


def segment(sp, chunk: str) -> list[int]:
    """Ids of one chunk; its first marker is the one that encoding adds."""
    return sp.encode(chunk[1:]) if len(chunk) > 1 else [sp.piece_to_id(MARK)]


class _Segments(dict):
    """Chunk to (ids as text with a space in front of each, decoded text); segments what it lacks."""

    def __init__(self, sp, head: dict):
        super().__init__(head)
        self.sp, self.head = sp, head

    def __missing__(self, chunk: str):
        if len(self) > TASK_ROWS + len(self.head):
            self.clear()
            self.update(self.head)
        ids = segment(self.sp, chunk)
        found = ("".join(f" {i}" for i in ids), " " + self.sp.decode(ids))
        if len(chunk) <= LONGEST:
            self[chunk] = found
        return found


def chunk_table(docs: DataFrame, model: bytes, rows: int | None = None) -> DataFrame:
    """``chunk, n, ids, decoded`` of every distinct chunk of up to LONGEST characters in ``docs.text``.

    All chunks are counted; with ``rows`` only the most frequent ones, so many at most, are segmented and returned.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()

        def out():
            kept = [(c, n) for c, n in found.items() if len(c) <= LONGEST]
            return pa.RecordBatch.from_pydict({"chunk": [c for c, _ in kept], "n": pa.array([n for _, n in kept], pa.int64())}, schema=pa.schema([("chunk", pa.string()), ("n", pa.int64())]))

        for batch in batches:
            for text in batch.column(0).to_pylist():
                found.update(chunks(text or ""))
            if len(found) > TASK_ROWS:
                yield out()
                found.clear()
        yield out()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sp = processor(shared.value)
        for batch in batches:
            found = [segment(sp, c) for c in batch.column(0).to_pylist()]
            decoded = pa.array([" " + sp.decode(ids) for ids in found], pa.string())
            columns = [batch.column(0), batch.column(1), pa.array(found, pa.list_(pa.int32())), decoded]
            yield pa.RecordBatch.from_arrays(columns, ["chunk", "n", "ids", "decoded"])

    counted = bounded_batches(docs).select("text").mapInArrow(count, "chunk string, n long").groupBy("chunk").agg(F.sum("n").alias("n"))
    if rows is not None:
        counted = most_frequent(materialised(counted), "n", rows)
    return materialised(counted.mapInArrow(encode, "chunk string, n long, ids array<int>, decoded string"))


def head_of(chunk_rows: DataFrame, rows: int = HEAD_ROWS) -> dict:
    """The most frequent chunks, ``rows`` at most, with ids as text and decoded text."""
    ids = F.concat(F.lit(" "), F.array_join(F.col("ids").cast("array<string>"), " "))
    top = most_frequent(chunk_rows, "n", rows).select("chunk", ids.alias("ids"), "decoded")
    found = top.toArrow()
    return dict(zip(found["chunk"].to_pylist(), zip(found["ids"].to_pylist(), found["decoded"].to_pylist())))


def encoded(docs: DataFrame, model: bytes, digests: bool = False, end_id: bool = True) -> DataFrame:
    """Ids and decoded text of every document: ``doc_id, n_tokens, ids, decoded``.

    With ``digests`` the last two are ``ids_sha256`` (of the decimal ids joined by
    one space) and ``decoded_sha256``. Ids are those of ``encode(text, add_eos=end_id)``
    and the text that of ``decode(ids)``. A null text is an empty one: the end id only.
    Every row gives one row, repeated or not, in any order; other columns are ignored.
    """
    check_vocabulary(model)
    context = docs.sparkSession.sparkContext
    shared, head = context.broadcast(model), context.broadcast(head_of(chunk_table(docs, model, HEAD_ROWS)))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sp = processor(shared.value)
        end = f" {sp.eos_id()}" if end_id else ""
        table = _Segments(sp, head.value)
        for batch in batches:
            counts, ids, decoded = [], [], []
            for text in batch.column(1).to_pylist():
                parts = [table[c] for c in chunks(text or "")]
                line = ("".join([p[0] for p in parts]) + end)[1:]
                plain = "".join([p[1] for p in parts])[1:]
                counts.append(line.count(" ") + 1 if line else 0)
                if digests:
                    ids.append(hashlib.sha256(line.encode()).hexdigest())
                    decoded.append(hashlib.sha256(plain.encode()).hexdigest())
                else:
                    ids.append([int(i) for i in line.split(" ")] if line else [])
                    decoded.append(plain)
            kinds = [pa.int64(), pa.string() if digests else pa.list_(pa.int32()), pa.string()]
            columns = [pa.array(v, t) for v, t in zip((counts, ids, decoded), kinds)]
            names = ["ids_sha256", "decoded_sha256"] if digests else ["ids", "decoded"]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", "n_tokens", *names])

    kind = docs.schema["doc_id"].dataType.simpleString()
    last = "ids_sha256 string, decoded_sha256 string" if digests else "ids array<int>, decoded string"
    return docs.select("doc_id", "text").mapInArrow(encode, f"doc_id {kind}, n_tokens long, {last}")


def decoded(encodings: DataFrame, model: bytes, column: str = "ids") -> DataFrame:
    """``encodings`` with ``decoded``: the text of each list of ids (null for null)."""
    shared = encodings.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("string")
    def decode(lists):
        sp = processor(shared.value)
        return lists.map(lambda x: None if x is None else sp.decode([int(i) for i in x]))

    return encodings.withColumn("decoded", decode(F.col(column)))


def read_model(path: str | None = None) -> bytes:
    """Bytes of a model file; by default the public BPE model of 32,000 pieces."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("piece_bpe_32k.model")
    with open(path, "rb") as f:
        return f.read()
