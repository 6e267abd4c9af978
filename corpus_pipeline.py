"""A corpus from raw documents to token ids: five stages, each over all that its predecessor kept.

A stage takes and returns the columns of ``documents``, whatever they are; the last returns the
columns of the encoder's report. Stages are written to the shared folder in between. Columns that a
stage does not look at may have any names. No documents give no rows in any stage.
"""

from pyspark.sql import DataFrame, SparkSession

from lexibid.llm import byte_bpe, exact_dedup, jaccard_join, language_id, mixing
from lexibid.llm.common import SLICED_BATCHES, discard, read_documents, ship_package, written


def prepare(spark: SparkSession) -> None:
    """Code on the executors, and batches of texts of about a megabyte for the session's Python workers."""
    ship_package(spark)
    for key, value in SLICED_BATCHES.items():
        spark.conf.set(key, value)


def with_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; texts that are null, empty or without letters go.

    Rows that repeat stay as often as they are there, rows without id too. Whole texts count.
    """
    prepare(spark)
    return language_id.determined(docs)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, A-Z in lower case, the document with the largest id.

    Null texts equal empty ones. Rows without id come last, and of rows that repeat an id and its
    text one stays.
    """
    return exact_dedup.without_copies(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id.

    Texts that are null or without words are in no group and stay. Rows without id come last, and of
    rows that repeat an id the first by where it is stored stays.
    """
    prepare(spark)
    return jaccard_join.one_of_each(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target weights of their sources ask for.

    A null source is a source of its own, and a null text has no size. Rows that repeat an id and
    its text are drawn alike. Reruns agree.
    """
    return mixing.mix(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids and the bytes decoded from them, as digests: one row per copy in the mix.

    A null text is empty. Rows without id have none in the result either.
    """
    prepare(spark)
    return byte_bpe.round_trip_report(docs)


STAGES = [
    ("language ID", with_language),
    ("exact dedup", without_copies),
    ("n-gram Jaccard join", without_near_copies),
    ("mixing sources to target weights", mixed),
    ("byte-level BPE encoding and decoding", encoded),
]

# Language models, near-duplicate components and merges are beyond SQL; tests/llm checks by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over ``documents``."""
    docs = read_documents(spark, sf_dir)
    for i, (_, stage) in enumerate(STAGES[:-1]):
        before, docs = docs, written(stage(spark, docs, sf_dir), f"stage-{i}")
        if i:
            discard(before)
    return STAGES[-1][1](spark, docs, sf_dir)
