"""Queries against DuckDB on whole tables, where SQL can say what they compute."""

import duckdb
import pytest

from lexibid.llm.oracle import all_oracles
from lexibid.llm.queries import all_queries

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(all_oracles()))
def test_matches_oracle(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "pages", "embeddings"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF_DIR}/{table}.parquet')")
    ours = all_queries()[name](spark, SF_DIR).toArrow()
    theirs = duck.sql(all_oracles()[name]).to_arrow_table()
    columns = sorted(ours.column_names)
    assert columns == sorted(theirs.column_names)
    rows = [sorted(zip(*(t.column(c).to_pylist() for c in columns), strict=True), key=repr) for t in (ours, theirs)]
    assert rows[0] == rows[1] and len(rows[0]) > 0
    kinds = [{f.name: str(f.type).replace("large_", "") for f in t.schema} for t in (ours, theirs)]
    assert kinds[0] == kinds[1]


def test_one_query_per_operator():
    numbers = [int(name[2:].split("_")[0]) for name in all_queries()]
    assert sorted(numbers) == list(range(1, 14))
