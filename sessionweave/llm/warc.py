"""WARC archives with an index: written once, read by sorted byte ranges.

``write_archives`` turns rows into WARC/1.1 records, each a gzip member of its
own, appended to the archives of the task that holds them. The index has archive,
offset, length, URL and digest of every record and is written by Spark, so it
only names archives of finished attempts; a lost executor leaves at most an
archive that no index row names. ``read_records`` takes any rows of the index,
sorts them by place, reads neighbouring records in one range and parses them.
Archives are reached through the shared folder's URI, never a local path of one machine.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionweave.llm.common import bounded_batches, materialised, scratch_path

#: Payloads below this size are stored each time.
LEAST_REVISIT = 1000
#: A task starts a new archive beyond this size.
ARCHIVE_BYTES = 256 << 20
#: Ranges closer than GAP are read as one, up to RANGE bytes.
GAP, RANGE = 64 << 10, 8 << 20
#: Archive bytes that one task reads back, and the least that are worth a task of their own.
TASK_BYTES, LEAST_TASK_BYTES = 64 << 20, 4 << 20

INDEX = "archive string, offset long, length long, page_id long, url string, payload_digest string, record_type string"
RECORD = (
    "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"
)


def _schema(spec: str) -> pa.Schema:
    kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
    return pa.schema([(n, kinds[t]) for n, t in (part.split() for part in spec.split(", "))])


def _batch(spec: str, rows: list[tuple]) -> pa.RecordBatch:
    schema = _schema(spec)
    columns = list(zip(*rows)) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _urn(page_id: int | None) -> str:
    return "<urn:page:none>" if page_id is None else f"<urn:page:{page_id}>"


def _page(urn: str) -> int | None:
    number = urn.strip("<>").rpartition(":")[2]
    return None if number == "none" else int(number)


def target_uri(url: str | None) -> str:
    """A URL on one header line: controls and per cent signs before them as escapes; null as an empty one."""
    return "" if url is None else "".join(f"%{ord(c):02X}" if c < " " or c == "\x7f" else c for c in url)


def record(page_id, url, payload: bytes, digest: str, refers_to, revisit: bool) -> bytes:
    """One WARC record. A revisit keeps the HTTP header, with the length of the payload it leaves out."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {_urn(page_id)}",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Target-URI: {target_uri(url)}",
        f"WARC-Payload-Digest: sha1:{digest}",
    ]
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {_urn(refers_to)}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> tuple:
    """Values of RECORD from the bytes of one record; digest and length of a response are taken from its payload."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    if len(block) != int(fields["Content-Length"]):
        raise ValueError("record cut short")
    http, _, payload = block.partition(b"\r\n\r\n")
    page, kind = _page(fields["WARC-Record-ID"]), fields["WARC-Type"]
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if kind == "revisit":
        size = next(int(h.split(b":")[1]) for h in http.split(b"\r\n") if h.lower().startswith(b"content-length:"))
        return page, fields["WARC-Target-URI"], kind, _page(fields["WARC-Refers-To"]), size, digest, None
    if hashlib.sha1(payload).hexdigest() != digest:
        raise ValueError("payload differs from its digest")
    return page, fields["WARC-Target-URI"], kind, None, len(payload), digest, payload


def roles(pages: DataFrame) -> DataFrame:
    """``page_id, url, payload, payload_digest, refers_to`` of every row of ``pages`` (``page_id, url, html``).

    Of rows with equal payloads of LEAST_REVISIT bytes or more the largest page_id
    is stored and ``refers_to`` of the others names it. Rows that share that
    page_id are all stored. Only digests are grouped, combined before they move.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    sized = bounded_batches(pages).select(F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("payload"))
    sized = sized.withColumn("payload_digest", F.sha1("payload"))
    large = F.octet_length("payload") >= LEAST_REVISIT
    groups = sized.where(large).groupBy(F.col("payload_digest").alias("_digest"))
    groups = groups.agg(F.max("page_id").alias("_first"), F.count(F.lit(1)).alias("_n")).where("_n > 1")
    groups = materialised(groups.select("_digest", "_first"))  # its size decides whether payloads have to move
    joined = sized.join(groups, large & (F.col("payload_digest") == F.col("_digest")), "left")
    refers = F.when(F.col("_digest").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_first")), F.struct("_first"))
    return joined.select("page_id", "url", "payload", "payload_digest", refers.isNotNull().alias("revisit"), refers["_first"].alias("refers_to"))


def write_archives(rows: DataFrame, folder: str, level: int = 1) -> DataFrame:
    """Write the rows of ``roles`` as archives under ``folder`` and return the written index."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = fs.FileSystem.from_uri(folder)
        store.create_dir(path, recursive=True)
        out, name, at = None, "", 0
        for batch in batches:
            found = []
            for page, url, payload, digest, revisit, refers in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None or at > ARCHIVE_BYTES:
                    if out is not None:
                        out.close()
                    name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                    out = store.open_output_stream(f"{path}/{name}", compression=None)
                pack = zlib.compressobj(level, zlib.DEFLATED, 31)
                member = pack.compress(record(page, url, payload, digest, refers, revisit)) + pack.flush()
                out.write(member)
                found.append((name, at, len(member), page, url, digest, "revisit" if revisit else "response"))
                at += len(member)
            yield _batch(INDEX, found)
        if out is not None:
            out.close()

    return materialised(rows.mapInArrow(write, INDEX))


def _ranges(rows: list[tuple]) -> Iterator[tuple[str, int, int, list[tuple]]]:
    """Neighbours of ``(archive, offset, length)`` rows, sorted by place, joined into ranges."""
    group: list[tuple] = []
    for row in rows:
        if group:
            start, end = group[0][1], group[-1][1] + group[-1][2]
            if row[0] != group[0][0] or row[1] - end > GAP or row[1] + row[2] - start > RANGE:
                yield group[0][0], start, end, group
                group = []
        group.append(row)
    if group:
        yield group[0][0], group[0][1], group[-1][1] + group[-1][2], group


def _read_tasks(index: DataFrame) -> int:
    """Tasks to read the records of ``index`` back: by the bytes they point to, not by the size of the index."""
    size = index.agg(F.sum("length")).first()[0] or 0
    cores = index.sparkSession.sparkContext.defaultParallelism
    return max(1, -(-size // TASK_BYTES), min(cores, -(-size // LEAST_TASK_BYTES)))


def read_records(index: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """Records that the rows of ``index`` name; ``payload`` is null for revisits, and for all without ``payloads``."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = fs.FileSystem.from_uri(folder)
        name, source = None, None
        for batch in batches:
            for archive, start, end, group in _ranges(list(zip(*(c.to_pylist() for c in batch.columns)))):
                if archive != name:
                    if source is not None:
                        source.close()
                    name, source = archive, store.open_input_file(f"{path}/{archive}")
                data = source.read_at(end - start, start)
                found = []
                for _, offset, length in group:
                    values = parse(zlib.decompress(data[offset - start : offset - start + length], 31))
                    found.append(values if payloads else (*values[:-1], None))
                yield _batch(RECORD, found)
        if source is not None:
            source.close()

    places = index.select("archive", "offset", "length")
    spread = places.repartitionByRange(_read_tasks(index), "archive", "offset").sortWithinPartitions("archive", "offset")
    return spread.mapInArrow(read, RECORD)


def archive_pages(pages: DataFrame) -> DataFrame:
    """Write ``pages`` as archives in the shared folder, read all of them back, and describe each record.

    One row for each row of ``pages``: ``page_id, url`` (as in the archive),
    ``record_type, refers_to, payload_bytes, payload_digest`` (bare hex SHA-1).
    A null html is an empty payload, a null URL an empty one; extra columns are ignored.
    """
    folder = f"{scratch_path(pages.sparkSession)}/archives"
    index = write_archives(roles(pages), folder)
    return read_records(index, folder, payloads=False).drop("payload")
