"""The text sink and the way back."""

import re
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import functions as F

from lexibid.operators.counts import count_per_key, sorted_by_key
from lexibid.operators.tokens import clean_words, tokens
from lexibid.sources.pairs import read_pairs, write_pairs
from lexibid.sources.shared import fresh_output_path
from lexibid.sources.text import read_lines


def part_lines(folder):
    parts = sorted(Path(folder).glob("part-*"))
    return [line for part in parts for line in part.read_text().split("\n")[:-1]]


def test_lines_and_global_order(spark, tmp_path, fixture_path):
    lines = read_lines(spark, fixture_path("paragraph_a.txt"))
    out = str(tmp_path / "out")
    write_pairs(sorted_by_key(count_per_key(clean_words(lines, "line"), "word"), "word"), out)
    written = part_lines(out)
    assert written[:3] == ["(a,3)", "(according,1)", "(after,2)"]
    assert all(re.fullmatch(r"\([a-z0-9]+,\d+\)", line) for line in written)
    assert written == sorted(written, key=lambda line: line[1:].split(",")[0])


def test_sorted_over_many_parts(spark, tmp_path):
    df = spark.range(100_000).select(F.md5(F.col("id").cast("string")).alias("word"), F.col("id").alias("cnt"))
    out = str(tmp_path / "out")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_pairs(sorted_by_key(df, "word"), out)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    written = part_lines(out)
    assert len(list(Path(out).glob("part-*"))) > 1
    assert len(written) == 100_000 and written == sorted(written)


def test_existing_folder_is_an_error(spark, tmp_path):
    df = spark.createDataFrame([("a", 1)], "word string, cnt bigint")
    write_pairs(df, str(tmp_path / "out"))
    with pytest.raises(AnalysisException, match="PATH_ALREADY_EXISTS"):
        write_pairs(df, str(tmp_path / "out"))


def test_roundtrip_of_awkward_tokens(spark, tmp_path):
    keys = ["", ",", "(a,1)", "a,b", ")", "\u2028", "\x85x", "\t", '"', "\xe9", "a\\"]
    df = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "tok string, cnt bigint")
    write_pairs(df, str(tmp_path / "out"), "tok")
    again = read_pairs(spark, str(tmp_path / "out"), "tok")
    assert sorted(map(tuple, again.collect())) == sorted((k, i) for i, k in enumerate(keys))
    assert again.schema["cnt"].dataType.simpleString() == "bigint"


def test_raw_counts_roundtrip(spark, tmp_path, fixture_path):
    counts = count_per_key(tokens(read_lines(spark, fixture_path("paragraph_b.txt"))), "tok")
    write_pairs(counts, str(tmp_path / "out"), "tok")
    again = read_pairs(spark, str(tmp_path / "out"), "tok")
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, counts.collect()))


def test_output_goes_to_the_shared_folder_if_one_is_set(spark):
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    first, second = fresh_output_path(spark, "x"), fresh_output_path(spark, "x")
    assert first.startswith(shared.rstrip("/")) and first != second


def test_without_a_shared_folder_nothing_is_written():
    class Bare:
        conf = {}
        sparkContext = type("Context", (), {"getCheckpointDir": lambda self: None})()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        fresh_output_path(Bare(), "x")


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize("row", [(None, 1), ("a", None), ("a\nb", 1), ("a\rb", 1), ("a", -1)])
def test_what_cannot_be_read_back_is_not_written(spark, tmp_path, row, ansi):
    df = spark.createDataFrame([row], "word string, cnt bigint")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(PySparkException, match="pair cannot be written"):
            write_pairs(df, str(tmp_path / "out"))
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize("line", ["", "a", "(a)", "(1)", "(a,)", "(a,x)", "(a,1", "a,1)", "(a,-1)", "(a,99999999999999999999)"])
def test_lines_that_are_no_pairs_fail_the_job(spark, tmp_path, line, ansi):
    (tmp_path / "in").write_text(f"(ok,1)\n{line}\n")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(PySparkException, match="not a pair"):
            read_pairs(spark, str(tmp_path / "in")).collect()
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")
