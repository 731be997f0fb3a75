import hashlib

import pytest
from pyspark.sql import functions as F

from sessionweave.llm.common import scratch_path
from sessionweave.llm.warc import _ranges, archive_pages, parse, read_records, record, roles, target_uri, write_archives

BIG = "x" * 1000


@pytest.fixture(scope="module")
def pages(spark):
    rows = [
        (1, "http://a/1", BIG),
        (2, "http://a/2", BIG),
        (3, "http://a/3", BIG),
        (4, None, "x" * 999),
        (5, "http://a/5", "x" * 999),
        (6, "bad\r\nurl\x00", None),
        (7, "http://a/7", ""),
        (8, "http://a/8", "ü" * 500),
        (9, "http://a/9", "ü" * 500),
        (9, "http://a/9", "ü" * 500),
        (10, "http://a/10", "WARC/1.1\r\n\r\nContent-Length: 5\r\n\r\n" + "y" * 3_000_000),
        (None, "http://a/none", "\r\n\r\n"),
    ]
    return spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("payload", F.lit(1))


def test_round_trip(spark, pages):
    got = archive_pages(pages).collect()
    assert len(got) == pages.count()
    html = {r.page_id: (r.html or "").encode() for r in pages.collect()}
    for r in got:
        assert r.payload_bytes == len(html[r.page_id]) and r.payload_digest == hashlib.sha1(html[r.page_id]).hexdigest()
    kinds = {r.page_id: (r.record_type, r.refers_to) for r in got}
    assert kinds[3] == ("response", None) and kinds[1] == kinds[2] == ("revisit", 3)
    assert kinds[4][0] == kinds[5][0] == kinds[6][0] == "response"
    assert kinds[8] == ("revisit", 9) and kinds[9] == ("response", None) and kinds[None][0] == "response"


def test_selected_records_only(spark, pages):
    folder = scratch_path(spark)
    index = write_archives(roles(pages), folder)
    assert {"archive", "offset", "length", "url", "payload_digest"} <= set(index.columns)
    some = read_records(index.where("page_id in (3, 10)"), folder).collect()
    assert {r.page_id: len(r.payload) for r in some} == {3: 1000, 10: 3_000_000 + 33}


def test_ranges_are_joined():
    rows = [("a", 0, 10), ("a", 10, 5), ("a", 10_000_000, 5), ("b", 0, 3)]
    assert [r[:3] for r in _ranges(rows)] == [("a", 0, 15), ("a", 10_000_000, 10_000_005), ("b", 0, 3)]


def test_damaged_records_are_found():
    good = record(1, "u", b"abc", hashlib.sha1(b"abc").hexdigest(), None, False)
    assert parse(good)[4] == 3
    with pytest.raises(ValueError):
        parse(good.replace(b"abc", b"abd"))
    with pytest.raises(ValueError):
        parse(b"x" + good)
    assert target_uri("a\r\nb") == "a%0D%0Ab" and target_uri(None) == ""


def test_empty_table(spark):
    assert archive_pages(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
