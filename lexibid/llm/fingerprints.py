"""Document fingerprints by content-defined chunking.

A rolling gear hash cuts a text where its own bytes say so, so an insertion moves no cuts but those
next to it. Cuts are normalised: rare ones up to the usual chunk length, frequent ones beyond
it. A fingerprint is the set of chunk digests with the chunks' lengths, and likeness
is containment weighted by length.
"""

import base64
import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Chunk lengths in bytes, and how often a byte allows a cut (1 in 2 to the n).
LEAST, USUAL, MOST = 8, 24, 96
RARE_BITS, FREQUENT_BITS = 6, 3
#: A gear hash of 16 bits forgets all but the last 16 bytes.
HASH_BITS = 16
DIGEST_BYTES = 6


def _gear_table() -> np.ndarray:
    """One random-looking number per byte value, from a rule."""
    digests = [hashlib.sha256(b"gear" + bytes([value])).digest() for value in range(256)]
    return np.array([int.from_bytes(d[:2], "little") for d in digests], dtype=np.uint16)


GEAR = _gear_table()


def gear_hashes(data: bytes) -> np.ndarray:
    """The hash after every byte: each step doubles it and adds the byte's number.

    Numbers of bytes further back than HASH_BITS have been shifted out, so the sum over the
    window is put together by doubling it.
    """
    hashes = GEAR[np.frombuffer(data, dtype=np.uint8)]
    width = 1
    while width < HASH_BITS:
        longer = hashes.copy()
        longer[width:] += hashes[:-width] << np.uint16(width)
        hashes, width = longer, 2 * width
    return hashes


def cuts(data: bytes) -> Iterator[int]:
    """Ends of the chunks of ``data``, the last one included; none for an empty text."""
    size = len(data)
    hashes = gear_hashes(data)
    often = np.flatnonzero(hashes < (1 << (HASH_BITS - FREQUENT_BITS))) + 1
    seldom = often[hashes[often - 1] < (1 << (HASH_BITS - RARE_BITS))].tolist()
    often = often.tolist()
    start = 0
    while size - start > LEAST:
        end = min(start + MOST, size)
        at = bisect_left(seldom, start + LEAST)
        if at < len(seldom) and seldom[at] < start + USUAL:
            end = min(seldom[at], size)
        else:
            at = bisect_left(often, start + USUAL)
            if at < len(often):
                end = min(often[at], end)
        yield end
        start = end
    if start < size:
        yield size


def chunk_set(text: str) -> dict[bytes, int]:
    """Digest of every distinct chunk and its length."""
    data = text.encode()
    chunks, start = {}, 0
    for end in cuts(data):
        chunks[xxhash.xxh3_64_digest(data[start:end])[:DIGEST_BYTES]] = end - start
        start = end
    return chunks


def packed(chunks: dict[bytes, int]) -> str:
    """The set as text: digests in order, each with its length in a byte."""
    return base64.b64encode(b"".join(d + bytes([chunks[d]]) for d in sorted(chunks))).decode()


def unpacked(fingerprint: str) -> dict[bytes, int]:
    raw, step = base64.b64decode(fingerprint), DIGEST_BYTES + 1
    return {raw[i : i + DIGEST_BYTES]: raw[i + DIGEST_BYTES] for i in range(0, len(raw), step)}


def containment(a: dict[bytes, int], b: dict[bytes, int]) -> float:
    """Bytes of the smaller set that the other contains too, 0 to 1; two empty sets are alike."""
    if not a or not b:
        return float(not a and not b)
    if len(b) < len(a):
        a, b = b, a
    shared = sum(length for digest, length in a.items() if digest in b)
    return shared / min(sum(a.values()), sum(b.values()))


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, fingerprint`` of every row of ``docs`` (``doc_id, text``; others are ignored).

    A null or empty text has an empty fingerprint.
    """

    def run(batches):
        for batch in batches:
            texts = batch.column("text").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([packed(chunk_set(t or "")) for t in texts], pa.string())],
                ["doc_id", "fingerprint"],
            )

    slim = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return slim.mapInArrow(run, "doc_id bigint, fingerprint string")


PLACED = "block int, follower boolean, doc_id bigint, text string"
REPORT = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)
REPORT_NAMES = [field.split()[0] for field in REPORT.split(", ")]
REPORT_TYPES = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]


def block_starts(docs: DataFrame, blocks: int) -> list[int]:
    """At most ``blocks`` ids that exist, largest first, cutting the ids into parts of about one size."""
    quantiles = [i / blocks for i in range(1, blocks)] or [0.5]
    found = docs.agg(F.max("doc_id"), F.percentile_approx("doc_id", quantiles, 10_000)).first()
    if found[0] is None:
        return []
    return sorted({found[0], *found[1]}, reverse=True)


def in_order(docs: DataFrame, blocks: int) -> DataFrame:
    """``docs`` sorted by descending id within blocks: ``block, follower, doc_id, text``.

    Blocks are ranges of ids and start at a document, so the one that follows a block's last
    document is known beforehand: it goes there as well, as its ``follower``. The first
    document of all follows the last. Text moves once. Rows without id get negative blocks.
    """
    starts = block_starts(docs, blocks)
    ascending = np.array(starts[::-1], dtype=np.int64)
    count = max(1, len(starts))

    def place(batches):
        for batch in batches:
            ids, texts = batch.column("doc_id"), batch.column("text")
            nulls = np.asarray(ids.is_null().to_numpy(zero_copy_only=False), dtype=bool)
            values = ids.fill_null(0).to_numpy()
            # a block starts at its largest id: count the starts at or above an id
            block = (count - np.searchsorted(ascending, values, side="left") - 1).astype(np.int32)
            block[nulls] = -1 - (np.arange(len(values), dtype=np.int32)[nulls] % count)
            yield pa.RecordBatch.from_arrays(
                [pa.array(block), pa.array(np.zeros(len(values), dtype=bool)), ids, texts],
                ["block", "follower", "doc_id", "text"],
            )
            first = np.flatnonzero(np.isin(values, ascending) & ~nulls)
            if len(first):
                rows = pa.array(first)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(((block[first] - 1) % count).astype(np.int32)),
                        pa.array(np.ones(len(first), dtype=bool)),
                        ids.take(rows),
                        texts.take(rows),
                    ],
                    ["block", "follower", "doc_id", "text"],
                )

    placed = docs.mapInArrow(place, PLACED)
    return placed.repartitionById(count, F.pmod("block", F.lit(count))).sortWithinPartitions(
        "block", "follower", F.col("doc_id").desc(), "text"
    )


def edited(text: str, following: str) -> str:
    """``text`` with its last third replaced by as much, or all, of the start of ``following``."""
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


def edit_report(docs: DataFrame) -> DataFrame:
    """Fingerprints of all documents and of their edited texts, and likenesses.

    ``docs`` has at least ``doc_id`` and ``text``; others are ignored. A null text is empty. The
    next document is that with the next smaller id, after the last the first; rows that repeat
    an id follow each other by text. A row without id follows nothing: its text stays as it
    is and ``near_next`` is null.
    """
    blocks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    slim = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text")
    )

    def compare(batches):
        before = None  # block, id, text and chunks of the row that waits for the one after it
        rows = []

        def report(doc_id, text, chunks, following, following_chunks):
            changed = edited(text, following)
            changed_chunks = chunks if changed == text else chunk_set(changed)
            rows.append(
                (
                    doc_id,
                    len(text),
                    hashlib.sha256(changed.encode()).hexdigest(),
                    packed(chunks),
                    packed(changed_chunks),
                    containment(chunks, changed_chunks),
                    None if following_chunks is None else containment(chunks, following_chunks),
                )
            )

        def flush():
            batch = pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), REPORT_TYPES, strict=True)], REPORT_NAMES
            )
            rows.clear()
            return batch

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("block", "follower", "doc_id", "text")]
            for block, follower, doc_id, text in zip(*columns, strict=True):
                chunks = chunk_set(text)
                if block < 0:
                    third = len(text) // 3
                    report(doc_id, text, chunks, text[len(text) - third :], None)
                    continue
                if before is not None and before[0] == block:
                    report(*before[1:], text, chunks)
                before = None if follower else (block, doc_id, text, chunks)
                if len(rows) >= 500:
                    yield flush()
        if rows:
            yield flush()

    return in_order(slim, blocks).mapInArrow(compare, REPORT)
