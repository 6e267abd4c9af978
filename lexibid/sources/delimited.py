"""Typed scans of delimited text without header or quoting."""

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexibid import fixed
from lexibid.functions.fields import required_field, writable
from lexibid.sources.text import read_lines, read_ordered_lines


def parse_delimited(lines: DataFrame, schema: T.StructType, separator: str, line: str = "line") -> DataFrame:
    """Split each line once and type its fields by position.

    Surplus fields are ignored. A missing field or a malformed number fails the job when a
    column that needs it is read; the result is non-nullable throughout. ``separator`` is
    literal text.
    """
    typed = [i for i, f in enumerate(schema.fields) if not isinstance(f.dataType, T.StringType)]
    last_typed = max(typed, default=-1)
    parts = lines.select(F.split(line, re.escape(separator)).alias("parts"))
    return parts.select(
        *(required_field("parts", i, f, last_typed) for i, f in enumerate(schema.fields))
    )


def read_delimited(spark: SparkSession, path: str, schema: T.StructType, separator: str) -> DataFrame:
    return parse_delimited(read_lines(spark, path), schema, separator)


def read_first(
    spark: SparkSession, path: str, schema: T.StructType, separator: str, n: int = fixed.HEAD_ROWS
) -> DataFrame:
    """The first ``n`` records in the order of the files; only they are parsed."""
    first = read_ordered_lines(spark, path).orderBy("file", "start", "row").limit(n)
    return parse_delimited(first, schema, separator)


def read_employees(spark: SparkSession, path: str) -> DataFrame:
    return read_delimited(spark, path, fixed.EMPLOYEE_SCHEMA, fixed.EMPLOYEE_SEPARATOR)


def read_bids(spark: SparkSession, path: str) -> DataFrame:
    return read_delimited(spark, path, fixed.BID_SCHEMA, fixed.BID_SEPARATOR)


def format_delimited(df: DataFrame, columns: list[str], separator: str) -> DataFrame:
    """The inverse of a scan: one ``line`` per row, the columns joined in order.

    A NULL, and a value that holds the separator or a line break, fails the job: what is written
    can be read back field by field.
    """
    values = [writable(F.col(c).cast("string"), c, separator) for c in columns]
    first, *rest = values
    return df.select(F.concat(first, *(part for v in rest for part in (F.lit(separator), v))).alias("line"))
