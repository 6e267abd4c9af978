import hashlib

import pytest
from pyspark.sql import functions as F

from lexibid.llm import exact_dedup as D
from lexibid.llm.common import located
from lexibid.sources.shared import fresh_output_path
from tests.llm.brute import normal

ROWS = [
    (1, "Same Text"),
    (5, "same text"),
    (3, "SAME TEXT"),
    (2, None),
    (4, ""),
    (6, "Kelvin"),
    (7, "kelvin"),
    (8, "É"),
    (9, "é"),
    (10, "x" * 300_000),
    (11, "X" * 300_000),
    (12, "y" * 300_000),
]


def expected(rows):
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(normal(text), []).append(doc_id)
    return {
        (doc_id, max(groups[t]), len(groups[t]), doc_id == max(groups[t]), hashlib.sha256(t.encode()).hexdigest())
        for doc_id, t in ((d, normal(t)) for d, t in rows)
    }


def test_groups(stored):
    assert set(map(tuple, D.dedup_report(stored(ROWS)).collect())) == expected(ROWS)


def test_rows_of_no_files(spark):
    assert set(map(tuple, D.dedup_report(spark.createDataFrame(ROWS, "doc_id bigint, text string")).collect())) == expected(ROWS)


def test_repeated_rows_and_missing_ids(stored):
    """Exactly one row of a group stays, also where ids repeat or are missing."""
    rows = [(1, "a"), (1, "a"), (None, "a"), (None, "b"), (None, "b"), (2, "c")]
    report = D.dedup_report(stored(rows)).collect()
    assert sorted((r.keep_id or 0, r.group_size) for r in report) == [(0, 2), (0, 2), (1, 3), (1, 3), (1, 3), (2, 1)]
    assert sum(r.kept for r in report) == 3
    assert {r.doc_id for r in report if r.kept} == {None, 1, 2}


def test_empty_table(stored):
    assert D.dedup_report(stored(ROWS).where("false")).collect() == []
    assert D.dedup_report(stored([])).collect() == []


def test_state_goes_on_with_later_documents(spark, stored):
    folder = fresh_output_path(spark, "state")
    first, second = located(stored(ROWS[:6], name="one")), located(stored(ROWS[6:] + [(20, "same TEXT")], name="two"))
    D.add_documents(first, folder, files_per_batch=1)
    D.add_documents(second, folder, files_per_batch=1)
    both = first.select(F.col("content.doc_id").alias("doc_id"), F.col("content.text").alias("text"), "file", "row")
    both = both.union(second.select("content.doc_id", "content.text", "file", "row"))
    rows = both.select(F.struct("doc_id", "text").alias("content"), "file", "row")
    found = D.groups(rows, folder).collect()
    kept = {r.doc_id: (r.keep.doc_id, r.group_size) for r in found}
    assert {k: v for k, v in kept.items() if k in (1, 3, 5, 20)} == {k: (20, 4) for k in (1, 3, 5, 20)}
    assert kept[4] == (4, 2) and kept[2] == (4, 2) and len(found) == 13


@pytest.mark.parametrize("characters", [0, 1])
def test_equal_digests_of_different_texts_are_told_apart(stored, characters):
    """Full bytes decide where the digest does not: here it is weak on purpose."""

    def weak(text):
        return F.substring(text, 1, characters).cast("binary")

    _, groups = D.exact_groups(stored(ROWS), digest=weak)
    kept = {(r.doc_id, r.keep.doc_id, r.group_size) for r in groups.collect()}
    assert kept == {row[:3] for row in expected(ROWS)}


def test_columns_stay_as_they_are(stored):
    docs = stored(ROWS)
    kept = D.without_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r[0] for r in expected(ROWS) if r[3])


def test_a_third_of_all_rows_is_one_text(spark):
    text = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string"))
    docs = spark.range(0, 30_000, numPartitions=6).select(F.col("id").alias("doc_id"), text.alias("text"))
    report = D.dedup_report(docs)
    hot = report.where("group_size > 1").groupBy("keep_id", "group_size").count().collect()
    assert [tuple(r) for r in hot] == [(29_997, 10_000, 10_000)]
    assert report.where("kept").count() == 20_001
