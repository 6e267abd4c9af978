from pathlib import Path
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import pytest

from lexibid.llm import common as C
from lexibid.llm import jaccard_join
from lexibid.sources.tables import read_table


def folder(spark):
    return Path(urlparse(C.intermediate_folder(spark)).path)


def test_intermediate_tables_go_by_one_call(spark, stored):
    docs = stored([(1, "a b c d e f"), (2, "A b c d e f"), (3, "x")])
    found = sorted(map(tuple, jaccard_join.component_report(docs).collect()))
    assert len(found) == 3 and any(folder(spark).iterdir())
    C.remove_intermediate(spark)
    assert not folder(spark).exists()
    assert sorted(map(tuple, jaccard_join.component_report(docs).collect())) == found


def test_discarded_tables_are_gone_and_no_others(spark, stored):
    docs = stored([(1, "a")])
    one, other = C.written(docs, "one"), C.written(docs, "other")
    C.discard(one, docs)
    assert not list(folder(spark).glob("one-*")) and other.count() == docs.count() == 1


def test_shuffle_files_go_with_their_job(spark):
    """Whoever needs the rows reads the table, so nothing else is kept of the job."""
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffle_files():
        found = blocks.getAllBlocks()
        return {n for n in (found.apply(i).name() for i in range(found.size())) if n.startswith("shuffle_")}

    before = shuffle_files()
    C.written(spark.range(1000).selectExpr("id % 7 AS k").groupBy("k").count(), "counts")
    assert shuffle_files() <= before


def test_settings_come_back(spark):
    key = "spark.sql.shuffle.partitions"
    was = spark.conf.get(key)
    with pytest.raises(ZeroDivisionError), C.session_settings(spark, {key: "3", "x.y": "z"}):
        assert spark.conf.get(key) == "3"
        raise ZeroDivisionError
    assert spark.conf.get(key) == was and spark.conf.get("x.y", None) is None


def test_slices_are_bounded_and_whole():
    texts = ["", "a" * 10, None, "é" * 30, "b", "c" * 5] * 20
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array(np.arange(len(texts)))], ["text", "n"])
    parts = list(C.slices(batch, "text", most=25))
    assert [n for p in parts for n in p.column("n").to_pylist()] == list(range(len(texts)))
    assert all(sum(len((t or "").encode()) for t in p.column("text").to_pylist()[:-1]) <= 25 for p in parts)
    assert list(C.slices(batch.slice(0, 0), "text")) == []


def test_a_table_elsewhere_is_never_removed(spark):
    table = read_table(spark, "/root/testdata/sf0.001", "documents", "doc_id bigint")
    C.discard(table)
    assert table.count() > 0


def test_a_batch_is_no_larger_than_a_slice():
    """Buffers of batches are kept on both sides, in the JVM and in its workers."""
    assert int(C.SLICED_BATCHES["spark.sql.execution.arrow.maxBytesPerBatch"]) <= C.SLICE_BYTES
