"""WARC archives."""

import gzip
import hashlib
import io
import zlib
from collections import Counter

import pytest

from lakemart.llm import warc

BIG, OTHER = "<p>é" + "x" * 1200, "y" * 999
PAGES = [
    (1, "http://a/1", BIG, 1, "z"),
    (5, "http://a/\r\n5", BIG, 1, "z"),
    (3, None, BIG, 1, "z"),
    (None, "http://a/n", BIG, 1, "z"),
    (6, "http://a/6", OTHER, 1, "z"),
    (7, "http://a/7", OTHER, 1, "z"),
    (8, "u", None, 1, None),
    (9, "u", "", None, "z"),
    (10, "u", "z" * 300_000 + "\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n", 1, "z"),
    (11, "u", "q" * 5000, 1, "z"),
    (11, "u", "q" * 5000, 1, "z"),
    (4, "u", "q" * 5000, 1, "z"),
]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame(PAGES, "page_id long, url string, html string, payload int, revisit string")


def _want():
    out = Counter()
    for page_id, _, html, *_ in PAGES:
        data = (html or "").encode()
        ids = [p[0] for p in PAGES if (p[2] or "").encode() == data and p[0] is not None]
        best = max(ids, default=None) if len([p for p in PAGES if (p[2] or "").encode() == data]) > 1 and len(data) >= 1000 else None
        revisit = best is not None and page_id != best
        out[page_id, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", best if revisit else None] += 1
    return out


def test_round_trip(pages):
    assert Counter(map(tuple, warc.archive_report(pages.repartition(3)).collect())) == _want()
    assert warc.archive_report(pages.filter("false")).count() == 0


def test_each_record_is_a_member(pages, tmp_path):
    whole = warc.write_archives(pages.coalesce(1), str(tmp_path / "whole"), file_bytes=2_000)
    assert whole.count() > 1
    for r in whole.collect():
        stream = zlib.decompressobj(31)
        stream.decompress(open(r["path"], "rb").read())
        assert stream.eof and not stream.unused_data
    members = warc.normalise(whole, str(tmp_path / "members"))
    index = warc.read_index(members).orderBy("path", "offset").collect()
    assert Counter(r["type"] for r in index)["warcinfo"] == whole.count()
    for r in index:
        with open(r["path"], "rb") as file:
            file.seek(r["offset"])
            record = gzip.decompress(file.read(r["length"]))
        headers, _ = warc.split_record(record)
        assert headers["warc-record-id"] == r["record_id"] and record.startswith(b"WARC/1.1\r\n")
    assert Counter(map(tuple, warc.read_records(members).collect())) == _want()


def test_normaliser_takes_members_and_refuses_cut_streams():
    records = [warc.page_record(i, "u", b"x" * i, None, False) for i in (1, 3_000_000, 0)]
    for data in (gzip.compress(b"".join(records)), b"".join(map(gzip.compress, records))):
        assert list(warc.records(warc.inflated(io.BytesIO(data)))) == records
    with pytest.raises(ValueError, match="cut off"):
        list(warc.records(warc.inflated(io.BytesIO(gzip.compress(records[1])[:-9]))))
    with pytest.raises(ValueError, match="inside a record"):
        list(warc.records(warc.inflated(io.BytesIO(gzip.compress(records[1][:-9])))))
