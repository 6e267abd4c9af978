"""Exact dedup by a stateful stream.

Documents are hashed into a table of digests. A stream over that table keeps, per digest and
without expiry, the identifier that stays, the locator of its content (file and row) and the
number of documents, in a state store on disk. State and position live in a folder, so later
documents meet all earlier ones. Where a digest was hit again, full bytes decide: the texts
behind it are grouped as they are, and digests shared by different texts are resolved by text.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexibid.llm.common import (
    flag_members,
    fresh_folder,
    located,
    lower_ascii,
    membership_filter,
    place,
    rows_without,
    session_settings,
    text_or_empty,
    written,
)

STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    # One memory budget for all stores of an executor, however many partitions it holds.
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "128",
    # Stores of many partitions are small each: no disk is set aside before it is needed.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    # A store's memory is given back when its batch is done; what it holds is on disk.
    "spark.sql.streaming.stateStore.unloadOnCommit": "true",
    # Replays read two versions at most.
    "spark.sql.streaming.minBatchesToRetain": "2",
}
DIGESTS = "doc_id bigint, file string, row bigint, digest binary"


def normal(text: str = "text") -> Column:
    """Equal texts have equal normal forms: null is empty, A-Z is lower case."""
    return lower_ascii(text_or_empty(text))


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def add_documents(
    rows: DataFrame,
    folder: str,
    digest: Callable[[Column], Column] = sha256,
    files_per_batch: int = 10_000,
) -> None:
    """Take ``rows`` (see ``located``) into the digest table and the state below ``folder``.

    May be called again with further rows. A run that breaks off goes on where it stopped.
    """
    spark = rows.sparkSession
    rows.select(
        F.col("content.doc_id").cast("bigint").alias("doc_id"),
        "file",
        "row",
        digest(normal("content.text")).alias("digest"),
    ).write.mode("append").parquet(f"{folder}/digests")

    arrivals = (
        spark.readStream.schema(DIGESTS)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(f"{folder}/digests")
    )
    # Counted within each task first: a hot digest reaches its state as one row per task.
    state = arrivals.groupBy("digest").agg(
        F.max(F.struct("doc_id", "file", "row")).alias("keep"), F.count(F.lit(1)).alias("group_size")
    )
    with session_settings(spark, STATE_SETTINGS):
        query = (
            state.writeStream.format("noop")
            .outputMode("update")
            .option("checkpointLocation", f"{folder}/state")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()


def read_state(spark: SparkSession, folder: str) -> DataFrame:
    """The state: ``digest, keep (doc_id, file, row), group_size``."""
    with session_settings(spark, STATE_SETTINGS):
        stored = spark.read.format("statestore").load(f"{folder}/state")
        names = stored.schema["value"].dataType.names
        return written(
            stored.select(
                "key.digest",
                F.col(f"value.`{names[0]}`").alias("keep"),
                F.col(f"value.`{names[1]}`").alias("group_size"),
            ),
            "dedup-state",
        )


def _hit_texts(
    rows: DataFrame, digests: DataFrame, hit: DataFrame, digest: Callable[[Column], Column]
) -> DataFrame:
    """Texts behind the digests in ``hit``, and few others: ``doc_id, file, row, digest, text``.

    Locators of the hits make a filter of fixed size, so other texts are not moved at all.
    """
    candidates = flag_members(digests, "digest", membership_filter(hit, "digest")).where("_maybe")
    places = membership_filter(candidates.select(place("file", "row")), "place")
    texts = rows.select(
        F.col("content.doc_id").cast("bigint").alias("doc_id"),
        "file",
        "row",
        place("file", "row"),
        F.col("content.text").alias("text"),
    )
    found = flag_members(texts, "place", places).where("_maybe")
    return found.select("doc_id", "file", "row", normal("text").alias("text")).withColumn(
        "digest", digest(F.col("text"))
    )


def groups(
    rows: DataFrame, folder: str, digest: Callable[[Column], Column] = sha256
) -> DataFrame:
    """The group of every row: ``doc_id, file, row, digest, keep (doc_id, file, row), group_size``.

    ``rows`` are all that were added to ``folder``.
    """
    spark = rows.sparkSession
    digests = spark.read.schema(DIGESTS).parquet(f"{folder}/digests")
    state = read_state(spark, folder)

    # Full bytes on hits: texts are grouping keys here, so copies meet within tasks first.
    texts = _hit_texts(rows, digests, state.where("group_size > 1"), digest)
    collisions = written(
        texts.groupBy("digest", "text").agg(F.lit(1).alias("one")).groupBy("digest").count().where("count > 1"),
        "dedup-collisions",
    )
    by_digest = digests.join(state, "digest").select("doc_id", "file", "row", "digest", "keep", "group_size")
    if collisions.isEmpty():
        return by_digest

    shared = _hit_texts(rows, digests, collisions, digest).join(collisions.select("digest"), "digest", "left_semi")
    per_text = shared.groupBy("digest", "text").agg(
        F.max(F.struct("doc_id", "file", "row")).alias("keep"), F.count(F.lit(1)).alias("group_size")
    )
    by_text = shared.join(per_text, ["digest", "text"]).select(*by_digest.columns)
    return by_digest.join(collisions, "digest", "left_anti").select(*by_digest.columns).unionByName(by_text)


def exact_groups(
    docs: DataFrame, digest: Callable[[Column], Column] = sha256, files_per_batch: int = 10_000
) -> tuple[DataFrame, DataFrame]:
    """Located rows of ``docs`` and their groups, through a fresh state.

    ``docs`` has at least ``doc_id`` and ``text``; other columns may have any names. Null texts
    equal empty ones. Of equal texts the row with the largest id stays, rows without id come
    last; rows that repeat an id and its text are told apart by where they are stored, so
    exactly one row of a group stays. No rows give no groups.
    """
    rows = located(docs)
    folder = fresh_folder(docs.sparkSession, "dedup")
    add_documents(rows, folder, digest, files_per_batch)
    return rows, groups(rows, folder, digest)


def _stays() -> Column:
    return (F.col("file") == F.col("keep.file")) & (F.col("row") == F.col("keep.row"))


def without_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, columns unchanged."""
    rows, found = exact_groups(docs)
    return rows_without(rows, found.where(~_stays())).select("content.*")


def dedup_report(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``."""
    _, found = exact_groups(docs)
    return found.select(
        "doc_id",
        F.col("keep.doc_id").alias("keep_id"),
        F.col("group_size").cast("bigint").alias("group_size"),
        _stays().alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
