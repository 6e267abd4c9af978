"""The named queries: name -> (spark, table directory) -> DataFrame."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lexibid import fixed
from lexibid.operators import auctions, auctions_sql, tabular, vocabulary
from lexibid.operators.counts import count_per_key, distinct_rows, row_count, sorted_by_key
from lexibid.operators.tokens import alpha_tokens, clean_words, first_words, token_total, tokens, word_total, words
from lexibid.plans import bindings
from lexibid.sources.delimited import parse_delimited, read_bids, read_employees
from lexibid.sources.pairs import read_pairs, write_pairs
from lexibid.sources.shared import fresh_output_path
from lexibid.sources.tables import temp_table
from lexibid.sources.text import read_lines, split_lines, write_lines

Query = Callable[[SparkSession, str], DataFrame]
Binding = Callable[[SparkSession, str], DataFrame]


def over(binding: Binding, *steps: Callable[[DataFrame], DataFrame]) -> Query:
    """The query that runs ``steps`` one after another over a binding."""

    def query(spark: SparkSession, directory: str) -> DataFrame:
        df = binding(spark, directory)
        for step in steps:
            df = step(df)
        return df

    return query


def compare(operator: Callable[[DataFrame, DataFrame], DataFrame], step, *after) -> Query:
    """The query that runs ``operator`` on both corpora, each sent through ``step`` first."""

    def query(spark: SparkSession, directory: str) -> DataFrame:
        df = operator(step(bindings.corpus_a(spark, directory)), step(bindings.corpus_b(spark, directory)))
        for step_after in after:
            df = step_after(df)
        return df

    return query


def counted(name: str) -> Callable[[DataFrame], DataFrame]:
    return lambda df: row_count(df, name)


def raw_counts(texts: DataFrame) -> DataFrame:
    return count_per_key(tokens(split_lines(texts)), "tok")


def clean_counts(texts: DataFrame) -> DataFrame:
    return sorted_by_key(count_per_key(clean_words(texts), "word"), "word")


def through_sink(key: str) -> Callable[[DataFrame], DataFrame]:
    """Write counts as text pairs and return what was written.

    The query writes when it is built. Its files lie below the session's shared folder until the
    session's owner deletes them: the result reads them whenever it is used.
    """

    def step(counts: DataFrame) -> DataFrame:
        spark = counts.sparkSession
        path = fresh_output_path(spark, "pairs")
        write_pairs(counts, path, key)
        return read_pairs(spark, path, key)

    return step


def through_files(reader: Callable[[SparkSession, str], DataFrame]) -> Callable[[DataFrame], DataFrame]:
    """Write lines as text files and return what ``reader`` makes of them.

    The query writes when it is built, and its files stay as those of ``through_sink`` do.
    """

    def step(lines: DataFrame) -> DataFrame:
        path = fresh_output_path(lines.sparkSession, "lines")
        write_lines(lines, path)
        return reader(lines.sparkSession, path)

    return step


def parsed_employees(spark: SparkSession, directory: str) -> DataFrame:
    lines = bindings.employee_lines(spark, directory)
    return parse_delimited(lines, fixed.EMPLOYEE_SCHEMA, fixed.EMPLOYEE_SEPARATOR)


def parsed_bids(spark: SparkSession, directory: str) -> DataFrame:
    lines = bindings.lineitem_bid_lines(spark, directory)
    return parse_delimited(lines, fixed.BID_SCHEMA, fixed.BID_SEPARATOR)


def parsed_event_bids(spark: SparkSession, directory: str) -> DataFrame:
    lines = bindings.event_bid_lines(spark, directory)
    return parse_delimited(lines, fixed.BID_SCHEMA, fixed.BID_SEPARATOR)


def _text_queries() -> dict[str, Query]:
    corpora = {"": bindings.corpus_a, "_b": bindings.corpus_b}
    queries: dict[str, Query] = {
        "text_lines": over(bindings.corpus, split_lines),
        "text_file_lines": over(bindings.corpus, split_lines, through_files(read_lines)),
        "tokens": over(bindings.corpus, split_lines, tokens),
        "alpha_tokens": over(bindings.corpus, alpha_tokens),
        "token_count": over(bindings.corpus, split_lines, lambda df: token_total(df, "tokens")),
        "token_count_a": over(bindings.corpus_a, split_lines, lambda df: token_total(df, "tokens")),
        "token_count_b": over(bindings.corpus_b, split_lines, lambda df: token_total(df, "tokens")),
        "wordcount_raw": over(bindings.corpus, raw_counts),
        "wordcount_clean": over(bindings.corpus, clean_counts),
        "wordcount_raw_sink_roundtrip": over(bindings.corpus, raw_counts, through_sink("tok")),
        "wordcount_sink_roundtrip": over(bindings.corpus, clean_counts, through_sink("word")),
    }
    for suffix, binding in corpora.items():
        queries[f"words{suffix}"] = over(binding, words)
        queries[f"first_words{suffix}"] = over(binding, lambda df: first_words(df, "doc_id"))
        queries[f"word_total{suffix}"] = over(binding, lambda df: word_total(df, "words"))
        queries[f"unique_words{suffix}"] = over(binding, words, distinct_rows)
        queries[f"unique_word_total{suffix}"] = over(binding, words, distinct_rows, counted("unique_words"))
    return queries


def _vocabulary_queries() -> dict[str, Query]:
    return {
        "vocab_only_in_a": compare(vocabulary.only_in_first, words),
        "vocab_only_in_a_count": compare(vocabulary.only_in_first, words, counted("only_in_a")),
        "vocab_common": compare(vocabulary.in_both, words),
        "vocab_common_count": compare(vocabulary.in_both, words, counted("common")),
        "corpus_summary": compare(vocabulary.corpus_summary, split_lines),
    }


def _tabular_queries() -> dict[str, Query]:
    return {
        "map_square": over(
            bindings.integers,
            lambda df: tabular.square(df, "p_size", "squared"),
            lambda df: tabular.project(df, "p_partkey", "squared"),
        ),
        "employees_project": over(
            bindings.employees, lambda df: tabular.project(df, "name", "age", "salary")
        ),
        "head_employees": over(bindings.employees, lambda df: tabular.head(df, "id")),
        "filter_project": over(bindings.employees, tabular.well_paid),
        "filter_project_sql": over(bindings.employees, tabular.well_paid_sql),
        "delim_scan_employees": parsed_employees,
        "delim_file_scan_employees": over(bindings.employee_lines, through_files(read_employees)),
        "delim_file_scan_bids": over(bindings.lineitem_bid_lines, through_files(read_bids)),
        "delim_filter_project": over(parsed_employees, tabular.well_paid),
        "delim_filter_project_sql": over(parsed_employees, tabular.well_paid_sql),
        "delim_scan_bids": parsed_bids,
        "delim_auction_count": over(parsed_bids, auctions.auction_count),
        "delim_item_stats": over(parsed_bids, auctions.item_stats),
        "delim_auction_stats": over(parsed_bids, auctions.auction_stats),
        "delim_bids_over_100": over(parsed_event_bids, auctions.bids_over_price_floor),
        "delim_bids_over_100_sql": over(parsed_event_bids, auctions_sql.bids_over_price_floor),
    }


def _auction_queries() -> dict[str, Query]:
    queries: dict[str, Query] = {
        "bids_schema": over(bindings.bids, tabular.schema_report),
        "bids_project": over(
            bindings.bids, lambda df: tabular.project(df, "auctionid", "bid", "bidtime", "item")
        ),
        "bids_temp_table": over(bindings.bids, temp_table),
        "head_bids": over(bindings.bids, lambda df: tabular.head(df, "bid_id")),
        "bids_per_auction": over(bindings.bids, auctions.bids_per_auction),
        "item_stats": over(bindings.bids, auctions.item_stats),
        "auction_stats": over(bindings.bids, auctions.auction_stats),
        "lineitem_auction_count": over(bindings.line_bids, auctions.auction_count),
        "lineitem_bids_per_auction": over(bindings.line_bids, auctions.bids_per_auction),
        "lineitem_item_stats": over(bindings.line_bids, auctions.item_stats),
        "lineitem_auction_stats": over(bindings.line_bids, auctions.auction_stats),
    }
    twins = {
        "auction_count": "auction_count",
        "bids_per_item": "bids_per_item",
        "min_bid_per_item": "min_bid_per_item",
        "max_bid_per_item": "max_bid_per_item",
        "avg_bid_per_item": "avg_bid_per_item",
        "min_bids_per_item": "min_bids_per_item",
        "max_bids_per_item": "max_bids_per_item",
        "avg_bids_per_item": "avg_bids_per_item",
        "bids_over_100": "bids_over_price_floor",
    }
    for name, operator in twins.items():
        queries[name] = over(bindings.bids, getattr(auctions, operator))
        queries[f"{name}_sql"] = over(bindings.bids, getattr(auctions_sql, operator))
    return queries


def all_queries() -> dict[str, Query]:
    return {**_text_queries(), **_vocabulary_queries(), **_tabular_queries(), **_auction_queries()}
