"""Lines of text, from files or from a text column."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexibid.functions import text as X


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per line of the files at ``path``: ``line``."""
    return spark.read.text(path).withColumnRenamed("value", "line")


def read_ordered_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with their place in the input: ``file, start, row, line``.

    ``start`` is the offset of the file split a line was read in, and ``row`` grows within
    a split but means nothing by itself. Sorted by the three, lines are in text order.
    """
    return spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("row"),
        F.col("value").alias("line"),
    )


def write_lines(lines: DataFrame, path: str, line: str = "line") -> None:
    """Write each row as one line; fails if ``path`` exists."""
    lines.select(F.col(line).alias("value")).write.mode("errorifexists").text(path)


def split_lines(texts: DataFrame, text: str = "text") -> DataFrame:
    """One row per line of each text: ``line``."""
    return texts.select(F.split(text, X.LINE_BREAK).alias("breaks")).select(
        F.explode(X.line_array(F.col("breaks"))).alias("line")
    )


def split_numbered_lines(texts: DataFrame, key: str, text: str = "text") -> DataFrame:
    """One row per line with its number within the text, from 0: ``key, ln, line``."""
    return texts.select(key, F.split(text, X.LINE_BREAK).alias("breaks")).select(
        key, F.posexplode(X.line_array(F.col("breaks"))).alias("ln", "line")
    )
