"""The queries over files instead of tables, grouped by the input they share.

Every report is a dict of lazy DataFrames: nothing runs until one of them is used, and each
reads its files anew. Persist an input first if several of its answers are wanted.
"""

from pyspark.sql import DataFrame, SparkSession

from lexibid import fixed
from lexibid.operators import auctions, auctions_sql, tabular, vocabulary
from lexibid.operators.counts import count_per_key, distinct_rows, sorted_by_key
from lexibid.operators.tokens import clean_words, first_words_of_lines, tokens, words
from lexibid.sources.delimited import read_bids, read_employees, read_first
from lexibid.sources.pairs import write_pairs
from lexibid.sources.text import read_lines, read_ordered_lines


def write_word_counts(spark: SparkSession, source: str, target: str) -> None:
    """Clean words of the text at ``source`` and their counts, sorted, as pairs at ``target``."""
    counts = count_per_key(clean_words(read_lines(spark, source), "line"), "word")
    write_pairs(sorted_by_key(counts, "word"), target)


def write_raw_token_counts(spark: SparkSession, source: str, target: str) -> None:
    """Tokens as they are and their counts, in no order, as pairs at ``target``."""
    write_pairs(count_per_key(tokens(read_lines(spark, source)), "tok"), target, "tok")


def compare_texts(
    spark: SparkSession, path_a: str, path_b: str, n: int = fixed.HEAD_ROWS
) -> dict[str, DataFrame]:
    """All counts in one row, the first ``n`` words, and the vocabularies of two texts."""
    a, b = read_lines(spark, path_a), read_lines(spark, path_b)
    words_a, words_b = words(a, "line"), words(b, "line")
    order = ["file", "start", "row"]
    return {
        "summary": vocabulary.corpus_summary(a, b),
        "first_words_a": first_words_of_lines(read_ordered_lines(spark, path_a), order, n=n),
        "first_words_b": first_words_of_lines(read_ordered_lines(spark, path_b), order, n=n),
        "unique_words_a": distinct_rows(words_a),
        "unique_words_b": distinct_rows(words_b),
        "only_in_a": vocabulary.only_in_first(words_a, words_b),
        "common": vocabulary.in_both(words_a, words_b),
    }


def employee_report(
    spark: SparkSession, path: str, floor: float = fixed.SALARY_FLOOR, n: int = fixed.HEAD_ROWS
) -> dict[str, DataFrame]:
    """All employees, the first ``n`` lines, and who gets more than ``floor``."""
    employees = read_employees(spark, path)
    return {
        "employees": employees,
        "head": read_first(spark, path, fixed.EMPLOYEE_SCHEMA, fixed.EMPLOYEE_SEPARATOR, n),
        "well_paid": tabular.well_paid(employees, floor),
        "well_paid_sql": tabular.well_paid_sql(employees, floor),
    }


BID_QUESTIONS = [
    "auction_count",
    "bids_per_item",
    "min_bid_per_item",
    "max_bid_per_item",
    "avg_bid_per_item",
    "min_bids_per_item",
    "max_bids_per_item",
    "avg_bids_per_item",
]


def bid_report(
    spark: SparkSession, path: str, floor: float = fixed.PRICE_FLOOR, n: int = fixed.HEAD_ROWS
) -> dict[str, DataFrame]:
    """Every question about the bids at ``path``, in the DataFrame form and (``_sql``) in SQL."""
    bids = read_bids(spark, path)
    report = {
        "bids": bids,
        "head": read_first(spark, path, fixed.BID_SCHEMA, fixed.BID_SEPARATOR, n),
        "schema": tabular.schema_report(bids),
        "bids_per_auction": auctions.bids_per_auction(bids),
        "item_stats": auctions.item_stats(bids),
        "auction_stats": auctions.auction_stats(bids),
        "bids_over_price_floor": auctions.bids_over_price_floor(bids, floor),
        "bids_over_price_floor_sql": auctions_sql.bids_over_price_floor(bids, floor),
    }
    for question in BID_QUESTIONS:
        report[question] = getattr(auctions, question)(bids)
        report[f"{question}_sql"] = getattr(auctions_sql, question)(bids)
    return report
