"""WARC archives: written with an index, read back by sorted and coalesced byte ranges.

Every record is a gzip member of its own, so a byte range of the index is a whole record. The
files of a task bear a name of their own and are known only through the index rows which that
task returns: what a lost task left behind is never read. Archives lie in the shared folder
and are opened through ``pyarrow.fs``, by the folder's scheme.
"""

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexibid.llm.common import fresh_folder, located, rows_without, text_or_empty, written

ID = "urn:x-page:"
DATE = "1970-01-01T00:00:00Z"
#: A file is closed and a new one begun beyond this size.
ARCHIVE_BYTES = 1 << 30
#: Ranges of a file closer than the gap are fetched at once, up to the most bytes of one read.
GAP_BYTES = 64 << 10
READ_BYTES = 8 << 20
#: Archive bytes that a task reads at most, but for the record that it begins last; on few bytes, less.
TASK_BYTES = 128 << 20
#: Rows handed to Spark at once.
BATCH_ROWS = 500

INDEX = (
    "file string, offset bigint, length bigint, url string, digest string, page_id bigint, record_type string"
)
RECORDS = (
    "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, "
    "refers_to bigint, payload binary"
)
INDEX_ARROW = pa.schema(
    [
        ("file", pa.string()),
        ("offset", pa.int64()),
        ("length", pa.int64()),
        ("url", pa.string()),
        ("digest", pa.string()),
        ("page_id", pa.int64()),
        ("record_type", pa.string()),
    ]
)
RECORDS_ARROW = pa.schema(
    [
        ("page_id", pa.int64()),
        ("url", pa.string()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("record_type", pa.string()),
        ("refers_to", pa.int64()),
        ("payload", pa.binary()),
    ]
)


def record_plan(pages: DataFrame, min_revisit_bytes: int = 0) -> DataFrame:
    """What to write per page: ``page_id, url, html, sha1, size, revisit, refers_to``.

    ``pages`` has at least ``page_id``, ``url`` and ``html``; other columns may have any names.
    A null html is empty, a null url stays null. Of records whose payloads are equal and of
    at least ``min_revisit_bytes``, one with the largest page_id is the response, and the
    others revisit it without a payload; null ids come last. Only one of several rows
    with the same id and payload is the response. The html of responses that no
    other page shares is not shuffled; revisits travel without theirs.
    """
    rows = located(pages)
    html = text_or_empty(F.col("content.html"))
    facts = rows.select(
        F.col("content.page_id").cast("bigint").alias("page_id"),
        F.col("content.url").alias("url"),
        "file",
        "row",
        F.sha1(html).alias("sha1"),
        F.unhex(F.sha2(html, 256)).alias("key"),
        F.octet_length(html).cast("bigint").alias("size"),
    ).where(F.col("size") >= min_revisit_bytes)
    shared = (
        facts.groupBy("key")
        .agg(F.max(F.struct("page_id", "file", "row")).alias("response"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
    )
    revisits = written(
        facts.join(shared, "key")
        .where("file <> response.file or row <> response.row")
        .select("page_id", "url", "sha1", "size", "file", "row", F.col("response.page_id").alias("refers_to")),
        "warc-revisits",
    )
    responses = rows_without(rows, revisits).select(
        F.col("content.page_id").cast("bigint").alias("page_id"),
        F.col("content.url").alias("url"),
        html.alias("html"),
        F.sha1(html).alias("sha1"),
        F.octet_length(html).cast("bigint").alias("size"),
        F.lit(False).alias("revisit"),
        F.lit(None).cast("bigint").alias("refers_to"),
    )
    return responses.unionByName(
        revisits.select(
            "page_id",
            "url",
            F.lit(None).cast("string").alias("html"),
            "sha1",
            "size",
            F.lit(True).alias("revisit"),
            "refers_to",
        )
    )


def _name(page_id) -> str:
    return f"<{ID}{'' if page_id is None else page_id}>"


def _number(name: str):
    digits = name[len(ID) + 1 : -1]
    return int(digits) if digits else None


def encode_record(row: dict) -> bytes:
    """One record, uncompressed. Characters that a header cannot hold are percent-encoded in the URL."""
    digest = base64.b32encode(bytes.fromhex(row["sha1"])).decode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['size']}\r\n\r\n"
    block = http.encode() + (b"" if row["revisit"] else row["html"].encode())
    headers = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if row['revisit'] else 'response'}",
        f"WARC-Record-ID: {_name(row['page_id'])}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {quote(row['url'] or '', safe='%/:=&?~#+!$,;@()*[]' + chr(39))}",
        f"WARC-Payload-Digest: sha1:{digest}",
    ]
    if row["revisit"]:
        headers.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        headers.append(f"WARC-Refers-To: {_name(row['refers_to'])}")
    headers += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(headers).encode() + block + b"\r\n\r\n"


def decode_record(raw: bytes) -> dict:
    """The record, its payload checked against its digest."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    headers = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    http, _, payload = rest[: int(headers["Content-Length"])].partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])
    digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
    kind = headers["WARC-Type"]
    if kind == "response" and base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
        raise ValueError(f"payload of {headers['WARC-Record-ID']} does not match its digest")
    return {
        "page_id": _number(headers["WARC-Record-ID"]),
        "url": headers["WARC-Target-URI"],
        "payload_bytes": int(fields["Content-Length"]),
        "payload_digest": digest,
        "record_type": kind,
        "refers_to": _number(headers["WARC-Refers-To"]) if kind == "revisit" else None,
        "payload": payload if kind == "response" else None,
    }


def _gzip(raw: bytes) -> bytes:
    packer = zlib.compressobj(level=3, wbits=31)
    return packer.compress(raw) + packer.flush()


def _in_batches(rows: Iterator[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held, held_bytes = [], 0
    for row in rows:
        held.append(row)
        held_bytes += len(row.get("payload") or b"")
        if len(held) >= BATCH_ROWS or held_bytes >= READ_BYTES:
            yield pa.RecordBatch.from_pylist(held, schema)
            held, held_bytes = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def _batch_rows(batch: pa.RecordBatch) -> Iterator[dict]:
    for start in range(0, batch.num_rows, BATCH_ROWS):
        yield from batch.slice(start, BATCH_ROWS).to_pylist()


def write_archives(plan: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write the planned records below ``folder``; returns the index, written as a table there.

    The index has ``file, offset, length, url, digest, page_id, record_type``.
    """

    def write(batches):
        def rows():
            store, root = pyarrow.fs.FileSystem.from_uri(folder)
            store.create_dir(f"{root}/archives", recursive=True)
            out, name, offset = None, None, 0
            try:
                for batch in batches:
                    for row in _batch_rows(batch):
                        if out is None or offset >= archive_bytes:
                            if out is not None:
                                out.close()
                            name, offset = f"archives/{uuid.uuid4().hex}.warc.gz", 0
                            out = store.open_output_stream(f"{root}/{name}", compression=None)
                        record = _gzip(encode_record(row))
                        out.write(record)
                        yield {
                            "file": name,
                            "offset": offset,
                            "length": len(record),
                            "url": row["url"],
                            "digest": row["sha1"],
                            "page_id": row["page_id"],
                            "record_type": "revisit" if row["revisit"] else "response",
                        }
                        offset += len(record)
            finally:
                if out is not None:
                    out.close()

        yield from _in_batches(rows(), INDEX_ARROW)

    plan.mapInArrow(write, INDEX).write.parquet(f"{folder}/index")
    return plan.sparkSession.read.parquet(f"{folder}/index")


def coalesced(ranges: list[tuple[int, int]], gap: int = GAP_BYTES, most: int = READ_BYTES) -> list[list[tuple[int, int]]]:
    """Sorted (offset, length) ranges put together: one list per read."""
    reads: list[list[tuple[int, int]]] = []
    for offset, length in ranges:
        if reads:
            start, (last, last_length) = reads[-1][0][0], reads[-1][-1]
            if offset - (last + last_length) <= gap and offset + length - start <= most:
                reads[-1].append((offset, length))
                continue
        reads.append([(offset, length)])
    return reads


def dealt(index: DataFrame, task_bytes: int | None = None) -> DataFrame:
    """``file, offset, length`` of ``index``, sorted, in partitions of ``task_bytes`` of archive each.

    Archives are taken one after another by name, and a record goes by the place of its first byte
    among all their bytes. Without ``task_bytes`` every core gets some, between READ_BYTES and
    TASK_BYTES. The window runs over one row per archive.
    """
    spark = index.sparkSession
    ends = index.groupBy("file").agg(F.max(F.col("offset") + F.col("length")).alias("bytes"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    starts = written(
        ends.select(F.col("file").alias("of"), "bytes", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("start")),
        "warc-starts",
    )
    total = starts.agg(F.sum("bytes")).first()[0] or 0
    if task_bytes is None:
        task_bytes = min(max(total // spark.sparkContext.defaultParallelism + 1, READ_BYTES), TASK_BYTES)
    task = F.floor((F.col("start") + F.col("offset")) / task_bytes).cast("int")
    rows = index.join(starts, F.col("file") == F.col("of")).select("file", "offset", "length", task.alias("task"))
    parts = rows.repartitionById(-(-total // task_bytes) or 1, "task")
    return parts.sortWithinPartitions("file", "offset").select("file", "offset", "length")


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """The records that ``index`` selects: ``page_id, url, payload_bytes, payload_digest,
    record_type, refers_to, payload``. ``index`` is the one of ``write_archives`` or any part of it.

    Ranges are sorted by file and offset across the cluster, so neighbours meet in one read, and
    dealt by archive bytes. Rows that repeat a range give its record again; an empty index gives no
    records. A null page_id, url and refers_to come back as null, empty and null.
    """

    def read(batches):
        store, root = pyarrow.fs.FileSystem.from_uri(folder)

        def rows():
            for batch in batches:
                files, at = batch.column("file").to_pylist(), 0
                ranges = list(zip(batch.column("offset").to_pylist(), batch.column("length").to_pylist(), strict=True))
                while at < len(files):
                    end = at
                    while end < len(files) and files[end] == files[at]:
                        end += 1
                    with store.open_input_file(f"{root}/{files[at]}") as source:
                        for together in coalesced(ranges[at:end]):
                            start = together[0][0]
                            size = together[-1][0] + together[-1][1] - start
                            data = source.read_at(size, start)
                            for offset, length in together:
                                yield decode_record(zlib.decompress(data[offset - start : offset - start + length], wbits=31))
                    at = end

        yield from _in_batches(rows(), RECORDS_ARROW)

    return dealt(index).mapInArrow(read, RECORDS)


def round_trip_report(pages: DataFrame) -> DataFrame:
    """All pages archived and read back: ``page_id, payload_bytes, payload_digest, record_type, refers_to``.

    See ``record_plan`` for nulls, repeated rows and ties.
    """
    folder = fresh_folder(pages.sparkSession, "warc")
    index = write_archives(record_plan(pages), folder)
    return read_records(index, folder).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )
