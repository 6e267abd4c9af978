import base64
import gzip
import hashlib
from pathlib import Path
from urllib.parse import urlparse

import pytest

from lexibid.llm import warc as W
from lexibid.sources.shared import fresh_output_path

PAGES = [
    (1, "http://a.example/", "<p>one</p>"),
    (2, "http://b.example/ä b", "<p>one</p>"),
    (3, None, "<p>ONE</p>"),
    (4, "http://c.example/\r\nx", None),
    (5, "http://d.example/", ""),
    (6, "http://e.example/", "ß漢🙂\r\n\r\nWARC/1.1\r\n" * 3),
    (7, "http://f.example/", "x" * 500_000),
    (8, "http://g.example/", "x" * 500_000),
]
SCHEMA = "page_id bigint, url string, html string"


def expected(pages):
    last = {}
    for page_id, _, html in pages:
        last[html or ""] = max(page_id, last.get(html or "", page_id))
    found = set()
    for page_id, _, html in pages:
        raw = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        first = last[html or ""]
        revisit = page_id != first
        found.add((page_id, len(raw), digest, "revisit" if revisit else "response", first if revisit else None))
    return found


def test_round_trip(stored):
    assert set(map(tuple, W.round_trip_report(stored(PAGES, SCHEMA)).collect())) == expected(PAGES)


def test_archives_are_plain_gzip_members(spark, stored):
    folder = fresh_output_path(spark, "warc")
    index = W.write_archives(W.record_plan(stored(PAGES, SCHEMA)), folder, archive_bytes=1)
    rows = index.collect()
    assert len({r.file for r in rows}) == len(rows) == len(PAGES)  # closed beyond the limit
    for row in rows:
        data = (Path(urlparse(folder).path) / row.file).read_bytes()[row.offset : row.offset + row.length]
        record = gzip.decompress(data)
        assert record.startswith(b"WARC/1.1\r\n") and record.endswith(b"\r\n\r\n")
        headers, _, rest = record.partition(b"\r\n\r\n")
        assert f"Content-Length: {len(rest) - 4}".encode() in headers
        assert (b"WARC-Refers-To: " in headers) == (row.record_type == "revisit")


def test_selected_records_are_read(spark, stored):
    folder = fresh_output_path(spark, "warc")
    index = W.write_archives(W.record_plan(stored(PAGES, SCHEMA)), folder)
    found = W.read_records(index.where("page_id in (2, 6, 7)"), folder).collect()
    payload = {r.page_id: r.payload for r in found}
    assert set(payload) == {2, 6, 7} and payload[7] is None
    assert bytes(payload[6]).decode() == PAGES[5][2] and bytes(payload[2]) == b"<p>one</p>"
    assert {r.page_id: r.url for r in found}[2] == "http://b.example/%C3%A4%20b"


def test_reads_are_dealt_by_bytes(spark):
    """Every byte of archive belongs to one task, and tasks have as many, whatever the sizes of records and files."""
    rows, sizes = [], {"b": [10] * 500, "a": [4000, 1, 7, 3000], "c": [100] * 30, "d": [1]}
    for file, lengths in sizes.items():
        offset = 0
        for length in lengths:
            rows.append((file, offset, length))
            offset += length
    index = spark.createDataFrame(rows, "file string, offset bigint, length bigint").repartition(5)
    parts = [p for p in W.dealt(index, task_bytes=1000).rdd.glom().collect()]
    assert len(parts) == -(-sum(map(sum, sizes.values())) // 1000)
    assert sorted(tuple(r) for p in parts for r in p) == sorted(rows)
    for part in parts:
        assert sum(r.length for r in part[:-1]) <= 1000
        assert part == sorted(part, key=lambda r: (r.file, r.offset))
    assert W.dealt(index.where("false")).collect() == []
    assert W.dealt(index).rdd.getNumPartitions() == 1  # too few bytes for more


def test_small_payloads_need_not_be_revisits(stored):
    plan = W.record_plan(stored(PAGES, SCHEMA), min_revisit_bytes=11)
    assert {r.page_id for r in plan.where("revisit").collect()} == {7}


def test_repeated_rows_and_missing_ids(stored):
    pages = [(1, "u", "a"), (1, "u", "a"), (None, "u", "a"), (None, "v", "b"), (None, "w", "b")]
    found = sorted((r.page_id or 0, r.record_type, r.refers_to or 0) for r in W.round_trip_report(stored(pages, SCHEMA)).collect())
    assert found == [(0, "response", 0), (0, "revisit", 0), (0, "revisit", 1), (1, "response", 0), (1, "revisit", 1)]


def test_empty_table(stored):
    assert W.round_trip_report(stored([], SCHEMA)).collect() == []


def test_ranges_are_put_together():
    ranges = [(0, 10), (10, 5), (100, 10), (1000, 10), (1011, 4)]
    assert W.coalesced(ranges, gap=20, most=1000) == [[(0, 10), (10, 5)], [(100, 10)], [(1000, 10), (1011, 4)]]
    assert W.coalesced(ranges, gap=1000, most=120) == [ranges[:3], ranges[3:]]
    assert W.coalesced([]) == []


def test_a_damaged_payload_is_an_error():
    row = {"page_id": 1, "url": "u", "html": "abc", "sha1": hashlib.sha1(b"abc").hexdigest(), "size": 3, "revisit": False}
    record = W.encode_record(row)
    assert W.decode_record(record)["payload"] == b"abc"
    with pytest.raises(ValueError, match="does not match"):
        W.decode_record(record.replace(b"abc", b"abd"))
