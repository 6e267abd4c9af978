"""The (key,count) text sink, and the way back."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: one output line is "(key,count)". The key may hold commas and brackets itself, so the
# count is what follows the last comma.
COUNT_END = r"\A[0-9]+\)\z"


def write_pairs(counts: DataFrame, path: str, key: str = "word", count: str = "cnt") -> None:
    """Write one ``(key,count)`` line per row; fails if ``path`` exists.

    A key or count that is NULL, a key with a line break and a count below zero fail the job.
    Part files in name order keep the order of a sorted input.
    """
    name, number = F.col(key), F.col(count)
    breaks = F.contains(name, F.lit("\n")) | F.contains(name, F.lit("\r"))
    bad = name.isNull() | number.isNull() | breaks | (number < 0)
    line = F.concat(F.lit("("), name, F.lit(","), number.cast("string"), F.lit(")"))
    shown = F.concat_ws(",", F.coalesce(name, F.lit("NULL")), F.coalesce(number.cast("string"), F.lit("NULL")))
    error = F.raise_error(F.concat(F.lit("pair cannot be written: "), shown)).cast("string")
    counts.select(F.when(bad, error).otherwise(line).alias("value")).write.mode("errorifexists").text(path)


def read_pairs(spark: SparkSession, path: str, key: str = "word", count: str = "cnt") -> DataFrame:
    """The pairs of the files at ``path``. A line that is none fails the job, whatever the ANSI setting."""
    value = F.col("value")
    lines = spark.read.text(path).select("value", F.substring_index("value", ",", -1).alias("tail"))
    number = F.expr("try_cast(left(tail, length(tail) - 1) AS bigint)")
    is_pair = (
        F.startswith(value, F.lit("("))
        & F.col("tail").rlike(COUNT_END)
        & (F.length("tail") < F.length("value") - 1)
        & number.isNotNull()
    )
    error = F.raise_error(F.concat(F.lit("not a pair: "), value))
    name = F.substring(value, F.lit(2), F.length("value") - F.length("tail") - 2)
    return lines.select(
        F.when(is_pair, name).otherwise(error.cast("string")).alias(key),
        F.when(is_pair, number).otherwise(error.cast("bigint")).alias(count),
    )
