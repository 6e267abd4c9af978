"""Row counts, distinct rows and counts per key."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def row_count(df: DataFrame, name: str) -> DataFrame:
    """One row, one column ``name``: the number of rows."""
    return df.agg(F.count(F.lit(1)).alias(name))


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.distinct()


def distinct_count(df: DataFrame, column: str, name: str) -> DataFrame:
    """Number of distinct values of ``column``; NULL counts as a value."""
    return row_count(df.select(column).distinct(), name)


def count_per_key(df: DataFrame, key: str, name: str = "cnt") -> DataFrame:
    """Rows per key. Counted per task before the shuffle, so a hot key travels as one row per task."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias(name))


def sorted_by_key(counts: DataFrame, key: str) -> DataFrame:
    """Globally sorted by key, ascending: a range shuffle of one row per key."""
    return counts.orderBy(key)
