"""Columns, tables and filters that several operators share."""

import ctypes
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexibid.sources.shared import shared_folder

# A word, as Java, Python and RE2 spell it.
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: Bits of a membership filter; at 8 MiB it may be broadcast whatever the size of the input.
FILTER_BITS = 1 << 26
#: Bits in one row of a filter: Spark's bitmap functions use buckets of this size.
BUCKET_BITS = 32768


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this library's code to the executors, once per application, so that tasks can import it."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp()) / f"{package.name}.zip"  # on the driver, which hands it out
    with zipfile.ZipFile(archive, "w") as files:
        for source in sorted(package.rglob("*.py")):
            files.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    _SHIPPED.add(context.applicationId)


def read_documents(spark: SparkSession, directory: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{directory}/documents.parquet")


def read_pages(spark: SparkSession, directory: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{directory}/pages.parquet")


def read_vectors(spark: SparkSession, directory: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{directory}/embeddings.parquet")


def text_or_empty(text: str | Column) -> Column:
    return F.coalesce(text if isinstance(text, Column) else F.col(text), F.lit(""))


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case and nothing else changed. Texts of ASCII alone take the fast way."""
    ascii_only = F.length(text) == F.octet_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


#: Shuffle files of a job go once its table is written: whoever needs the rows reads the table.
CLEAN_SHUFFLES = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def intermediate_folder(spark: SparkSession) -> str:
    """Where this application's intermediate tables are, within the shared folder."""
    return f"{shared_folder(spark)}/intermediate-{spark.sparkContext.applicationId}"


def fresh_folder(spark: SparkSession, name: str) -> str:
    """A new path among the intermediate ones."""
    return f"{intermediate_folder(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: cuts lineage, survives lost executors.

    The table stays until ``discard`` or ``remove_intermediate``.
    """
    spark = df.sparkSession
    path = fresh_folder(spark, name)
    with session_settings(spark, CLEAN_SHUFFLES):
        df.write.parquet(path)
    return spark.read.parquet(path)


def _remove(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def discard(*tables: DataFrame) -> None:
    """Remove tables of ``written`` that nothing reads any more."""
    for table in tables:
        for folder in {file.rsplit("/", 1)[0] for file in table.inputFiles()}:
            if f"/{intermediate_folder(table.sparkSession).rsplit('/', 1)[1]}/" in folder:
                _remove(table.sparkSession, folder)


def remove_intermediate(spark: SparkSession) -> None:
    """Remove all intermediate tables of this application, once results that read them are written."""
    _remove(spark, intermediate_folder(spark))


def membership_filter(keys: DataFrame, key: str) -> DataFrame:
    """A filter of fixed size over the hashes of ``key``: one row per bucket with any member."""
    bits = keys.select(F.pmod(F.xxhash64(key), F.lit(FILTER_BITS)).alias("bit")).distinct()
    return bits.groupBy(F.expr(f"bit div {BUCKET_BITS}").alias("_bucket")).agg(
        F.expr(f"bitmap_construct_agg(bit % {BUCKET_BITS})").alias("_members")
    )


def flag_members(rows: DataFrame, key: str, members: DataFrame) -> DataFrame:
    """``rows`` with ``_maybe``: false where ``key`` is certainly not in the filter.

    The filter is broadcast: it has at most ``FILTER_BITS`` bits, whatever the input. A fuller
    filter flags more rows in vain but never misses a member.
    """
    bit = F.pmod(F.xxhash64(key), F.lit(FILTER_BITS))
    probed = rows.withColumn("_bit", bit).withColumn("_bucket", F.expr(f"_bit div {BUCKET_BITS}"))
    byte = f"substring(_members, cast((_bit % {BUCKET_BITS}) div 8 as int) + 1, 1)"
    is_set = F.expr(f"(cast(conv(hex({byte}), 16, 10) as int) >> cast(_bit % 8 as int)) & 1 = 1")
    joined = probed.join(F.broadcast(members), "_bucket", "left")
    return joined.select(*rows.columns, F.coalesce(is_set, F.lit(False)).alias("_maybe"))


#: Bytes of text that a task turns into Python objects at once, and of a batch that Spark sends to it: what
#: buffers a batch on both sides is kept for the next one.
SLICE_BYTES = 1 << 20
SLICED_BATCHES = {"spark.sql.execution.arrow.maxBytesPerBatch": str(SLICE_BYTES)}


def slices(batch: pa.RecordBatch, *columns: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``most`` bytes in ``columns`` (strings or binary), or one row that has more."""
    sizes = np.zeros(batch.num_rows, dtype=np.int64)
    for column in columns:
        sizes += np.asarray(pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)
    part = (np.cumsum(sizes) - sizes) // most
    bounds = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(sizes)]
    for begin, end in zip(bounds[:-1], bounds[1:], strict=True):
        if end > begin:
            yield batch.slice(begin, end - begin)


def release_memory() -> None:
    """Give memory that is free back to the system: workers live on, and others need it."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


@contextmanager
def session_settings(spark: SparkSession, settings: dict[str, str]):
    """Settings for the jobs started inside; what was there before comes back."""
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def located(docs: DataFrame) -> DataFrame:
    """``docs`` as ``content, file, row``: all columns in a struct, and where the row is stored.

    A scan of files knows; anything else is stored first.
    """
    try:
        metadata = docs.metadataColumn("_metadata")
        return docs.select(
            F.struct("*").alias("content"), metadata["file_path"].alias("file"), metadata["row_index"].alias("row")
        )
    except AnalysisException:
        return located(written(docs, "content"))


def place(file: str, row: str) -> Column:
    return F.xxhash64(file, row).alias("place")


def rows_without(rows: DataFrame, dropped: DataFrame) -> DataFrame:
    """``rows`` (see ``located``) but for those whose ``file, row`` is in ``dropped``.

    Only rows that may have to go are moved: a filter of fixed size over the dropped places
    lets all others pass, and a join decides on those it holds back.
    """
    dropped = written(dropped.select("file", "row", place("file", "row")), "dropped")
    flagged = flag_members(rows.withColumn("place", place("file", "row")), "place", membership_filter(dropped, "place"))
    held = flagged.where("_maybe").join(dropped.select("file", "row"), ["file", "row"], "left_anti")
    return flagged.where("not _maybe").select(*rows.columns).unionByName(held.select(*rows.columns))
