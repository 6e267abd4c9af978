"""Difference, overlap and the one-pass summary of two corpora."""

import pytest
from pyspark.sql import functions as F

from lexibid.operators.tokens import tokens, words
from lexibid.operators.vocabulary import corpus_summary, in_both, only_in_first
from lexibid.sources.text import read_lines

# Fixed answers for the two given paragraphs.
ONLY_IN_A = """according after all associated at bernie came caucuses contests cruz day democratic donald
finishes four further giving him j kansas kentucky losses louisiana maine marco nominating nomination out
presidential press reach republican sanders senator shut string ted texas that threatened trump vermont
victory was won""".split()
COMMON = "a and florida his in mr of on primary puerto push rico rubio sunday the to".split()


@pytest.fixture(scope="module")
def paragraphs(spark, fixture_path):
    return [read_lines(spark, fixture_path(f"paragraph_{x}.txt")) for x in "ab"]


def test_paragraph_vocabularies(paragraphs, values):
    a, b = (words(p, "line") for p in paragraphs)
    assert values(only_in_first(a, b)) == ONLY_IN_A
    assert values(in_both(a, b)) == COMMON
    assert len(ONLY_IN_A) + len(COMMON) == a.distinct().count()


def test_paragraph_summary(paragraphs):
    assert corpus_summary(*paragraphs).first().asDict() == {
        "tokens_a": 103,
        "tokens_b": 117,
        "words_a": 100,
        "words_b": 111,
        "unique_words_a": 61,
        "unique_words_b": 76,
        "only_in_a": 45,
        "common": 16,
    }


def test_duplicates_and_the_empty_word(spark, values):
    a = spark.createDataFrame([("x",), ("x",), ("",), ("y",), ("y",)], "word string")
    b = spark.createDataFrame([("y",), ("y",), ("z",)], "word string")
    assert values(only_in_first(a, b)) == ["", "x"]
    assert values(only_in_first(b, a)) == ["z"]
    assert values(in_both(a, b)) == ["y"]


def test_agrees_with_set_operators(spark):
    a = spark.range(5000).select((F.col("id") % 701).cast("string").alias("word"))
    b = spark.range(3000).select((F.col("id") * 3 % 1009).cast("string").alias("word"))
    for ours, theirs in (
        (only_in_first(a, b), a.distinct().subtract(b)),
        (in_both(a, b), a.distinct().intersect(b)),
    ):
        assert ours.exceptAll(theirs).isEmpty() and theirs.exceptAll(ours).isEmpty()


def test_empty_sides(spark, values):
    some = spark.createDataFrame([("x",)], "word string")
    none = some.limit(0)
    assert values(only_in_first(some, none)) == ["x"]
    assert values(only_in_first(none, some)) == values(in_both(some, none)) == []
    empty = spark.createDataFrame([], "line string")
    assert set(corpus_summary(empty, empty).first().asDict().values()) == {0}


def test_summary_counts_non_words_as_tokens_only(spark):
    a = spark.createDataFrame([("a - a .",), ("  ",), ("",)], "line string")
    b = spark.createDataFrame([("A, $",)], "line string")
    summary = corpus_summary(a, b).first().asDict()
    assert summary == {
        "tokens_a": tokens(a).count(),
        "tokens_b": 2,
        "words_a": 3,
        "words_b": 1,
        "unique_words_a": 2,
        "unique_words_b": 1,
        "only_in_a": 1,
        "common": 1,
    }
    assert summary["tokens_a"] == 5


def test_a_word_that_holds_a_third_of_all_rows(spark):
    hot = F.when(F.col("id") % 3 == 0, F.lit("the")).otherwise(F.col("id").cast("string"))
    a = spark.range(0, 300_000, numPartitions=8).select(hot.alias("word"))
    b = spark.range(0, 30_000, numPartitions=8).select(hot.alias("word"))
    assert in_both(a, b).count() == 20_001
    assert only_in_first(a, b).count() == 180_000
