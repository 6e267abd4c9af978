"""Whole reports over files."""

import random
from pathlib import Path

import pytest

from lexibid.operators.tokens import first_words_of_lines
from lexibid.plans import files
from lexibid.sources.pairs import read_pairs
from lexibid.sources.text import read_ordered_lines
from tests.test_auctions import GOLDEN
from tests.test_text import PARAGRAPH_STARTS
from tests.test_vocabulary import COMMON, ONLY_IN_A


def test_word_count_files(spark, tmp_path, fixture_path):
    files.write_word_counts(spark, fixture_path("paragraph_a.txt"), str(tmp_path / "clean"))
    clean = [tuple(r) for r in read_pairs(spark, str(tmp_path / "clean")).collect()]
    assert len(clean) == 64 and sum(c for _, c in clean) == 103 and ("the", 8) in clean
    files.write_raw_token_counts(spark, fixture_path("paragraph_a.txt"), str(tmp_path / "raw"))
    raw = [tuple(r) for r in read_pairs(spark, str(tmp_path / "raw")).collect()]
    assert len(raw) == 67 and sum(c for _, c in raw) == 103 and ("much-needed", 1) in raw


def test_compare_texts(spark, fixture_path, values):
    report = files.compare_texts(spark, fixture_path("paragraph_a.txt"), fixture_path("paragraph_b.txt"))
    assert tuple(report["summary"].first()) == (103, 117, 100, 111, 61, 76, 45, 16)
    for letter in "ab":
        start = " ".join(r.word for r in report[f"first_words_{letter}"].collect())
        assert start == PARAGRAPH_STARTS[f"paragraph_{letter}.txt"]
    assert values(report["only_in_a"]) == ONLY_IN_A
    assert values(report["common"]) == COMMON
    assert report["unique_words_a"].count() == 61 and report["unique_words_b"].count() == 76


def test_employee_report(spark, fixture_path):
    report = files.employee_report(spark, fixture_path("employees.txt"))
    assert report["employees"].count() == 3
    assert [r.name for r in report["head"].collect()] == ["Michael", "Andy", "Justin"]
    assert [r.name for r in files.employee_report(spark, fixture_path("employees.txt"), n=1)["head"].collect()] == ["Michael"]
    assert [r.name for r in report["well_paid"].collect()] == ["Justin"]
    assert [r.name for r in report["well_paid_sql"].collect()] == ["Justin"]


def test_bid_report(spark, fixture_path):
    report = files.bid_report(spark, fixture_path("bids.csv"))
    for question, answer in GOLDEN.items():
        for form in (question, f"{question}_sql"):
            assert sorted(map(tuple, report[form].collect())) == answer
    assert report["bids_over_price_floor"].count() == report["bids_over_price_floor_sql"].count() == 3
    assert {r.nullable for r in report["schema"].collect()} == {False}
    head = files.bid_report(spark, fixture_path("bids.csv"), floor=50, n=2)
    assert head["head"].collect() == report["bids"].collect()[:2]
    assert head["bids_over_price_floor"].count() == head["bids_over_price_floor_sql"].count() == 6


@pytest.mark.parametrize("split_bytes", ["64", "1000", "134217728"])
def test_first_words_follow_file_order_over_many_splits(spark, tmp_path, split_bytes):
    rng = random.Random(3)
    expected = []
    for name in ("a.txt", "b.txt", "c.txt"):
        lines = [" ".join(rng.choices(["-", "x.", "Y", "z1", "$"], k=rng.randrange(6))) for _ in range(200)]
        Path(tmp_path / name).write_text("\n".join(lines))
        expected += [t.lower().replace(".", "") for line in lines for t in line.split(" ") if t[:1].isalnum()]
    spark.conf.set("spark.sql.files.maxPartitionBytes", split_bytes)
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        lines = read_ordered_lines(spark, str(tmp_path))
        ours = first_words_of_lines(lines, ["file", "start", "row"], n=700).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert [r.word for r in ours] == expected[:700]
