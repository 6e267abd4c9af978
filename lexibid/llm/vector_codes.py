"""Vector code compression: every part of a vector is replaced by the number of a codebook entry.

The nearest entry is found by equal-average search. Entries are sorted by the sum of their
components, and a search begins at a part's own sum and goes outward: the squared gap between
two sums over the dimension is never more than the squared distance, so a side is done when that
bound strictly exceeds the best distance. All numbers are integers, so results do not
depend on the order in which Spark adds them up.
"""

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexibid.llm.common import written

# Parts of a vector, entries of a codebook, rounds of training, and the grid.
PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256.0
#: Components on the grid stay within this over the part dimension, so that all squares and sums fit a long.
REACH = 1 << 28
#: Components worked on at once.
PORTION = 1 << 19

ROWS = "vec_id bigint, label int, code string, error bigint"


def whole_vectors(rows: DataFrame) -> DataFrame:
    """The rows whose vector is there and has neither null nor non-finite components: ``vec_id, label, embedding``."""
    slim = rows.select(F.col("vec_id").cast("bigint").alias("vec_id"), "label", "embedding")
    infinity = F.lit(float("inf"))
    finite = (F.array_max("embedding") < infinity) & (F.array_min("embedding") > -infinity)
    complete = F.size(F.array_compact("embedding")) == F.size("embedding")
    return slim.where("embedding is not null").where(complete & F.coalesce(finite, F.lit(True)))


def on_grid(vectors: pa.Array, dimension: int) -> np.ndarray:
    """Vectors as whole numbers, parts x vectors x part dimension; shorter vectors end with zeros."""
    width = dimension // PARTS
    lengths = np.asarray(vectors.value_lengths().to_numpy(zero_copy_only=False), dtype=np.int64)
    values = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    grid = np.clip(np.floor(values * SCALE), -(REACH // width), REACH // width).astype(np.int64)
    if not (lengths == dimension).all():
        padded = np.zeros((len(lengths), dimension), dtype=np.int64)
        row = np.repeat(np.arange(len(lengths)), lengths)
        padded[row, np.arange(len(grid)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = grid
        grid = padded
    return np.ascontiguousarray(grid.reshape(len(lengths), PARTS, width).transpose(1, 0, 2))


@dataclass(frozen=True)
class Codebooks:
    """Entries of all parts (parts x entries x part dimension)."""

    entries: np.ndarray

    @property
    def dimension(self) -> int:
        return self.entries.shape[0] * self.entries.shape[2]

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry and the squared distance, parts x vectors. Of equals, the lower index."""
        _, vectors, width = parts.shape
        sums = self.entries.sum(axis=2)
        order = np.argsort(sums, axis=1, kind="stable")
        # Sums at both ends that are too far from all others to be reached.
        ends = np.full((PARTS, 1), 4 * REACH)
        by_sum = np.concatenate([-ends, np.take_along_axis(sums, order, axis=1), ends], axis=1)
        order = np.pad(order, ((0, 0), (1, 1)))
        own = parts.sum(axis=2)
        right = np.concatenate([np.searchsorted(by_sum[j], own[j]) for j in range(PARTS)])
        left = right - 1
        book = np.repeat(np.arange(PARTS), vectors)
        flat, own = parts.reshape(-1, width), own.ravel()
        best = np.full(len(flat), width * (2 * REACH // width) ** 2 + 1)
        entry = np.zeros(len(flat), dtype=np.int64)
        rows = np.arange(len(flat))
        while len(rows):
            to_left, to_right = own[rows] - by_sum[book[rows], left], by_sum[book[rows], right] - own[rows]
            # The nearer side goes first: once its bound is too large, so is the other's.
            gap = np.minimum(to_left, to_right)
            near = gap * gap <= best[rows] * width
            goes_left = (to_left <= to_right)[near]
            rows, left, right = rows[near], left[near], right[near]
            candidate = order[book[rows], np.where(goes_left, left, right)]
            distance = ((flat[rows] - self.entries[book[rows], candidate]) ** 2).sum(axis=1)
            better = (distance < best[rows]) | ((distance == best[rows]) & (candidate < entry[rows]))
            best[rows[better]], entry[rows[better]] = distance[better], candidate[better]
            left, right = left - goes_left, right + ~goes_left
        return entry.reshape(PARTS, vectors), best.reshape(PARTS, vectors)

    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def _portions(batch: pa.RecordBatch, dimension: int) -> Iterator[pa.RecordBatch]:
    step = max(1, PORTION // dimension)
    for start in range(0, batch.num_rows, step):
        yield batch.slice(start, step)


def first_codebooks(vectors: DataFrame) -> Codebooks:
    """Each part's entries are that part of the vectors with the smallest ids.

    Rows of one id are told apart by their components, rows without id come last. The dimension
    is that of the longest vector, rounded up to a multiple of the number of parts.
    """
    longest = vectors.agg(F.max(F.size("embedding"))).first()[0] or 0
    dimension = PARTS * max(1, -(-longest // PARTS))
    order = [F.col("vec_id").asc_nulls_last(), F.col("embedding")]
    smallest = vectors.select("vec_id", "embedding").orderBy(*order).limit(ENTRIES).toArrow()  # ENTRIES rows
    given = smallest.column("embedding").combine_chunks()
    return Codebooks(on_grid(given, dimension))


def trained(vectors: DataFrame, books: Codebooks, rounds: int = ROUNDS) -> Codebooks:
    """``books`` after so many rounds of assigning all vectors and averaging.

    A task sends one row per entry, whatever its number of vectors, and Spark adds them up; what
    reaches the driver is of the size of the codebooks. Entries without vectors stay.
    """
    spark = vectors.sparkSession
    width = books.dimension // PARTS
    columns = [f"s{k}" for k in range(width)]
    kinds = ", ".join(f"{c} bigint" for c in ("slot", "n", *columns))
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(books)

        def add(batches, shared=shared):
            own = shared.value
            size = own.entries.shape[1]
            count = np.zeros(PARTS * size, dtype=np.int64)
            sums = np.zeros((PARTS * size, width), dtype=np.int64)
            for batch in batches:
                for part in _portions(batch, own.dimension):
                    grid = on_grid(part.column("embedding"), own.dimension)
                    slot = (own.nearest(grid)[0] + np.arange(PARTS)[:, None] * size).ravel()
                    order = np.argsort(slot, kind="stable")
                    used, first = np.unique(slot[order], return_index=True)
                    sums[used] += np.add.reduceat(grid.reshape(-1, width)[order], first, axis=0)
                    count += np.bincount(slot, minlength=len(count))
            used = np.flatnonzero(count)
            yield pa.RecordBatch.from_arrays(
                [pa.array(used), pa.array(count[used]), *(pa.array(sums[used, k]) for k in range(width))],
                ["slot", "n", *columns],
            )

        totals = (
            vectors.select("embedding")
            .mapInArrow(add, kinds)
            .groupBy("slot")
            .agg(F.sum("n").alias("n"), *(F.sum(c).alias(c) for c in columns))
            .toArrow()
        )
        shared.unpersist()
        slot, count = totals.column("slot").to_numpy(), totals.column("n").to_numpy()
        entries = books.entries.reshape(-1, width).copy()
        for k, column in enumerate(columns):
            entries[slot, k] = totals.column(column).to_numpy() // count
        books = Codebooks(entries.reshape(books.entries.shape))
    return books


def encoded(vectors: DataFrame, books: Codebooks) -> DataFrame:
    """``vec_id, label, code, error`` of every vector: two hex digits per part, and its squared distance."""
    shared = vectors.sparkSession.sparkContext.broadcast(books)

    def encode(batches):
        own = shared.value
        for batch in batches:
            for part in _portions(batch, own.dimension):
                index, distance = own.nearest(on_grid(part.column("embedding"), own.dimension))
                digits = index.T.astype(np.uint8).tobytes().hex()
                codes = [digits[i : i + 2 * PARTS] for i in range(0, len(digits), 2 * PARTS)]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("vec_id"),
                        part.column("label").cast(pa.int32()),
                        pa.array(codes, pa.string()),
                        pa.array(distance.sum(axis=0)),
                    ],
                    ["vec_id", "label", "code", "error"],
                )

    return vectors.mapInArrow(encode, ROWS)


def fitted(vectors: DataFrame) -> Codebooks:
    """Codebooks of ``vectors`` (see ``whole_vectors``); of none, codebooks without entries."""
    books = first_codebooks(vectors)
    return trained(vectors, books) if books.entries.size else books


def code_report(rows: DataFrame) -> DataFrame:
    """One row per vector kept: ``vec_id, code, error, label_error, codebooks_sha256``.

    ``rows`` has at least ``vec_id, embedding, label``; other columns may have any names. Vectors that
    are null or hold null or non-finite components are dropped; an empty vector is one of
    zeros, and shorter vectors end with zeros. Repeated ids are rows of their own. ``label_error`` sums
    the errors of equal labels, null labels being equal, and is null beyond a long. Fewer than
    ENTRIES vectors give as many entries; no vectors give no rows.
    """
    vectors = whole_vectors(rows)
    books = fitted(vectors)
    codes = written(encoded(vectors, books), "vector-codes")
    sums = written(
        codes.groupBy(F.col("label").alias("of_label")).agg(F.expr("try_sum(error)").alias("label_error")), "vector-errors"
    )
    return codes.join(sums, F.col("label").eqNullSafe(F.col("of_label"))).select(
        "vec_id", "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256")
    )
