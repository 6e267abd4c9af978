"""Comparing the vocabularies of two corpora.

A word is in a corpus or not, however often it occurs. Both corpora go through a single
aggregation that keeps two flags per word. It combines within each task first, so frequent
words cost one row per task; nothing is joined, sorted or broadcast.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexibid import fixed
from lexibid.functions import text as X
from lexibid.operators.tokens import token_count


def _membership(a: DataFrame, b: DataFrame, column: str) -> DataFrame:
    tagged = a.select(column, F.lit(True).alias("a"), F.lit(False).alias("b")).union(
        b.select(column, F.lit(False).alias("a"), F.lit(True).alias("b"))
    )
    return tagged.groupBy(column).agg(F.bool_or("a").alias("in_a"), F.bool_or("b").alias("in_b"))


def only_in_first(a: DataFrame, b: DataFrame, column: str = "word") -> DataFrame:
    """Distinct values of ``a`` that ``b`` does not have."""
    return _membership(a, b, column).where("in_a and not in_b").select(column)


def in_both(a: DataFrame, b: DataFrame, column: str = "word") -> DataFrame:
    """Distinct values that both have."""
    return _membership(a, b, column).where("in_a and in_b").select(column)


def corpus_summary(lines_a: DataFrame, lines_b: DataFrame, line: str = "line") -> DataFrame:
    """All counts of a two-corpus comparison from one pass over each corpus.

    One row: tokens, words and distinct words of each corpus, words only in the first and
    words in both. Only words become rows; the first of a line brings the number of its tokens
    along, and lines without words meet in the NULL group, one row per task.
    """

    def counted(lines: DataFrame, own: str, other: str) -> DataFrame:
        found = X.matching_token_array(F.col(line), fixed.WORD_TOKEN)
        rows = lines.select(token_count(line).alias("n"), F.posexplode_outer(found).alias("i", "tok"))
        is_first = F.coalesce("i", F.lit(0)) == 0
        return rows.select(
            X.word_form(F.col("tok")).alias("word"),
            F.when(F.col("tok").isNotNull(), 1).otherwise(0).alias(own),
            F.lit(0).alias(other),
            F.when(is_first, F.col("n")).otherwise(0).alias(f"tokens_{own}"),
            F.lit(0).cast("bigint").alias(f"tokens_{other}"),
        )

    counts = ["a", "b", "tokens_a", "tokens_b"]
    both = counted(lines_a, "a", "b").unionByName(counted(lines_b, "b", "a"))
    per_word = both.groupBy("word").agg(*(F.sum(c).alias(c) for c in counts))

    is_word, in_a, in_b = F.col("word").isNotNull(), F.col("a") > 0, F.col("b") > 0

    def total(column, condition=F.lit(True)):
        return F.coalesce(F.sum(F.when(condition, column)), F.lit(0).cast("bigint"))

    return per_word.agg(
        total(F.col("tokens_a")).alias("tokens_a"),
        total(F.col("tokens_b")).alias("tokens_b"),
        total(F.col("a"), is_word).alias("words_a"),
        total(F.col("b"), is_word).alias("words_b"),
        F.count_if(is_word & in_a).alias("unique_words_a"),
        F.count_if(is_word & in_b).alias("unique_words_b"),
        F.count_if(is_word & in_a & ~in_b).alias("only_in_a"),
        F.count_if(is_word & in_a & in_b).alias("common"),
    )
