"""Quality classifier: a convolutional network over bytes, in numpy.

A filter is a weight per byte value and place in its window. The windows of a text, one from every
byte on, are dealt to chunks that overlap by what a window reaches beyond its start, so the chunks
cover the whole text whatever its length. Each filter's largest answer in a chunk is what the
chunk says, and the largest, mean and smallest of its chunks are what a text says: a logistic unit
makes one probability of them.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexibid.llm.common import read_documents, slices, text_or_empty

# The fold that is never learned from (remainder and modulus), and where label 1 begins.
FOLD, FOLDS = 0, 5
THRESHOLD = 0.3

#: Size of the network: filters, bytes in a window, windows in a chunk.
FILTERS = 32
WIDTH = 6
CHUNK = 256
#: The bounded sample to learn from: labelled rows, those of the smallest hashes of their ids, and
#: chunks of a row, evenly spaced over the whole text where it has more.
SAMPLE_ROWS = 3000
SAMPLE_CHUNKS = 32
#: Passes over the sample, rows in a step, and the step's size.
PASSES = 8
STEP_ROWS = 64
RATE = 0.01

#: Chunks that filters are put to at once.
BLOCK = 256
#: Fills the last window of a text. A text's own null characters look the same.
PAD = b"\0" * (WIDTH - 1)


@dataclass(frozen=True)
class Network:
    """Filters (window place x byte x filter), their biases, and weights and bias of the last unit."""

    filters: np.ndarray
    bias: np.ndarray
    weights: np.ndarray
    prior: np.ndarray

    def answers(self, windows: list[np.ndarray]) -> np.ndarray:
        """Every filter's answer to every window; ``windows[place]`` are the bytes there."""
        found = self.filters[0][windows[0]]
        for table, bytes_there in zip(self.filters[1:], windows[1:], strict=True):
            found += table[bytes_there]
        return found


def starting_network(prior: float) -> Network:
    """Small filters by a fixed seed, so that reruns agree; every text scores as ``prior``."""
    rng = np.random.Generator(np.random.PCG64(12))
    filters = rng.normal(0, 0.1, (WIDTH, 256, FILTERS)).astype(np.float32)
    odds = np.log(prior / (1 - prior))
    return Network(filters, np.zeros(FILTERS, np.float32), np.zeros(3 * FILTERS, np.float32), np.array([odds], np.float32))


def _of_texts(chunks: np.ndarray, first: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Largest, mean and smallest over the chunks of each text."""
    largest = np.maximum.reduceat(chunks, first, axis=0)
    smallest = np.minimum.reduceat(chunks, first, axis=0)
    return largest, np.add.reduceat(chunks, first, axis=0) / counts[:, None], smallest


def _chance(network: Network, features: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(features @ network.weights + network.prior, -30, 30)))


def chunk_answers(network: Network, stream: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The largest answers in each chunk. Its windows begin at ``starts`` to ``ends`` in the stream of bytes."""
    pooled = np.empty((len(starts), FILTERS), dtype=np.float32)
    for begin in range(0, len(starts), BLOCK):
        end = min(begin + BLOCK, len(starts))
        first, last = starts[begin], ends[end - 1]
        near = stream[first : last + WIDTH - 1].astype(np.intp)
        size = last - first
        found = network.answers([near[w : w + size] for w in range(WIDTH)])
        # Windows that begin in the padding between two texts are of no chunk.
        bounds = np.column_stack([starts[begin:end], ends[begin:end]]).ravel()[:-1] - first
        own, at = np.unique(bounds, return_index=True)
        pooled[begin:end] = np.maximum.reduceat(found, own, axis=0)[np.searchsorted(own, starts[begin:end] - first)]
    return np.tanh(pooled + network.bias)


def scores(network: Network, texts: list[bytes]) -> np.ndarray:
    """The probability of label 1 for every whole text; an empty one is a window of padding."""
    if not texts:
        return np.zeros(0)
    stream = np.frombuffer(b"".join(part for text in texts for part in (text or b"\0", PAD)), dtype=np.uint8)
    windows = np.array([max(1, len(t)) for t in texts], dtype=np.int64)
    offsets = np.cumsum(windows + WIDTH - 1) - (windows + WIDTH - 1)
    counts = -(-windows // CHUNK)
    first = np.cumsum(counts) - counts
    nth = np.arange(counts.sum()) - np.repeat(first, counts)
    starts = np.repeat(offsets, counts) + nth * CHUNK
    ends = np.minimum(starts + CHUNK, np.repeat(offsets + windows, counts))
    pooled = chunk_answers(network, stream, starts, ends)
    return _chance(network, np.concatenate(_of_texts(pooled, first, counts), axis=1))


def sample_chunks(text: bytes) -> bytes:
    """Chunks to learn from, one after another, each filled up to CHUNK + WIDTH - 1 bytes."""
    count = max(1, -(-len(text) // CHUNK))
    chosen = range(count) if count <= SAMPLE_CHUNKS else np.linspace(0, count - 1, SAMPLE_CHUNKS).astype(int)
    size = CHUNK + WIDTH - 1
    return b"".join(text[i * CHUNK : i * CHUNK + size].ljust(size, b"\0") for i in chosen)


def _gradient(network: Network, chunks: np.ndarray, counts: np.ndarray, labels: np.ndarray) -> list[np.ndarray]:
    """Of the mean log loss over some rows, by what the network consists of."""
    answers = network.answers([chunks[:, w : w + CHUNK] for w in range(WIDTH)])
    at = answers.argmax(axis=1)
    pooled = np.tanh(np.take_along_axis(answers, at[:, None], axis=1)[:, 0] + network.bias)
    first, owner = np.cumsum(counts) - counts, np.repeat(np.arange(len(counts)), counts)
    largest, mean, smallest = _of_texts(pooled, first, counts)
    features = np.concatenate([largest, mean, smallest], axis=1)
    off = ((_chance(network, features) - labels) / len(labels)).astype(np.float32)
    of_largest, of_mean, of_smallest = np.split(off[:, None] * network.weights, 3, axis=1)
    back = (of_mean / counts[:, None])[owner]
    back += of_largest[owner] * (pooled == largest[owner])
    back += of_smallest[owner] * (pooled == smallest[owner])
    back *= 1 - pooled**2
    row, kind = np.arange(len(chunks))[:, None], np.arange(FILTERS)
    filters = np.stack(
        [
            np.bincount(
                (chunks[row, at + w] * FILTERS + kind).ravel(), weights=back.ravel(), minlength=256 * FILTERS
            ).reshape(256, FILTERS)
            for w in range(WIDTH)
        ]
    )
    return [filters, back.sum(axis=0), off @ features, off.sum(keepdims=True)]


def fit(rows: list[tuple[bytes, int]]) -> Network:
    """Learn from (sample chunks, label) pairs by Adam. Labels of one kind, or none, give their share alone."""
    labels = np.array([label for _, label in rows], dtype=np.float32)
    network = starting_network((labels.sum() + 0.5) / (len(labels) + 1))
    if len(set(labels.tolist())) < 2:
        return network
    size = CHUNK + WIDTH - 1
    chunks = [np.frombuffer(raw, dtype=np.uint8).reshape(-1, size) for raw, _ in rows]
    rng = np.random.Generator(np.random.PCG64(13))
    network = Network(
        network.filters, network.bias, rng.normal(0, 0.1, 3 * FILTERS).astype(np.float32), network.prior
    )
    state = [network.filters, network.bias, network.weights, network.prior]
    slow, fast = [np.zeros_like(s) for s in state], [np.zeros_like(s) for s in state]
    step = 0
    for _ in range(PASSES):
        order = rng.permutation(len(rows))
        for start in range(0, len(order), STEP_ROWS):
            own = order[start : start + STEP_ROWS]
            counts = np.array([len(chunks[i]) for i in own])
            together = np.concatenate([chunks[i] for i in own]).astype(np.intp)
            step += 1
            for k, slope in enumerate(_gradient(Network(*state), together, counts, labels[own])):
                slow[k] = 0.9 * slow[k] + 0.1 * slope
                fast[k] = 0.999 * fast[k] + 0.001 * slope**2
                move = slow[k] / (1 - 0.9**step) / (np.sqrt(fast[k] / (1 - 0.999**step)) + 1e-8)
                state[k] = (state[k] - RATE * move).astype(np.float32)
    return Network(*state)


def _fold() -> Column:
    return F.crc32(F.col("doc_id").cast("string")) % FOLDS


def trained(docs: DataFrame, labels: DataFrame) -> Network:
    """Learn from a sample of ``docs`` (``doc_id, text``) with ``labels`` (``doc_id, quality``).

    Rows of the held-out fold, without id or without label are not learned from. A document with
    several labels has the smallest. The sample is SAMPLE_ROWS rows at most: ids are
    chosen from the labels alone, so that only those texts are looked at, and what reaches the
    driver are SAMPLE_CHUNKS chunks of each at most.
    """
    own = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    known = own.where("doc_id is not null and quality is not null").where(_fold() != FOLD)
    by_hash = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = known.groupBy("doc_id").agg(F.min("quality").alias("quality")).orderBy(*by_hash).limit(SAMPLE_ROWS)

    def cut(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                raw = [sample_chunks(t) for t in part.column("text").cast(pa.binary()).to_pylist()]
                columns = [part.column("doc_id"), part.column("quality"), pa.array(raw, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "quality", "chunks"])

    rows = docs.join(F.broadcast(chosen), "doc_id").select("doc_id", "quality", "text")  # SAMPLE_ROWS rows
    sample = (
        rows.mapInArrow(cut, "doc_id bigint, quality int, chunks binary")
        .orderBy(*by_hash, "chunks")
        .limit(SAMPLE_ROWS)
        .toArrow()
    )
    return fit([(raw, int(q == 1)) for raw, q in zip(*(sample.column(c).to_pylist() for c in ("chunks", "quality")), strict=True)])


def scored(docs: DataFrame, network: Network) -> DataFrame:
    """``doc_id, held_out, score`` of every row of ``docs`` (``doc_id, held_out, text``)."""
    shared = docs.sparkSession.sparkContext.broadcast(network)

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                found = scores(shared.value, part.column("text").cast(pa.binary()).to_pylist())
                columns = [part.column("doc_id"), part.column("held_out"), pa.array(found, pa.float64())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "score"])

    return docs.mapInArrow(run, "doc_id bigint, held_out boolean, score double")


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, held_out, score, predicted``, learned from ``labels``.

    ``docs`` has at least ``doc_id, text`` and ``labels`` at least ``doc_id, quality``; others are ignored. A
    null text is empty; empty texts all have one score. Rows that repeat an id are scored by
    their own texts, equal texts equally. Rows without id are neither held out nor learned from. No
    labels, or labels of one kind, give every text the same score. No documents give no rows.
    """
    slim = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty("text").alias("text"))
    network = trained(slim, labels)
    with_fold = slim.select("doc_id", F.coalesce(_fold() == FOLD, F.lit(False)).alias("held_out"), "text")
    return scored(with_fold, network).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def quality_report(spark: SparkSession, directory: str) -> DataFrame:
    """``quality`` of the table of documents, by the table of labels."""
    return quality(read_documents(spark, directory), spark.read.parquet(f"{directory}/labels.parquet"))
