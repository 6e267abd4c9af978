"""Which table plays which role. Only the columns a role has are read."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexibid import fixed
from lexibid.sources.delimited import format_delimited
from lexibid.sources.tables import read_table


# The columns used, with the types they have in the files.
DOCUMENTS = "doc_id bigint, text string"
BENCHMARK = "item_id bigint, text string"
CUSTOMER = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double"
EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double"
LINEITEM = (
    "l_orderkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, "
    "l_discount double, l_tax double, l_returnflag string, l_linestatus string"
)
PART = "p_partkey bigint, p_size int"


def corpus(spark: SparkSession, directory: str) -> DataFrame:
    """All documents: ``doc_id, text``."""
    return read_table(spark, directory, "documents", DOCUMENTS)


def corpus_a(spark: SparkSession, directory: str) -> DataFrame:
    """The first of two corpora: all documents, as ``doc_id, text``."""
    return corpus(spark, directory)


def corpus_b(spark: SparkSession, directory: str) -> DataFrame:
    """The second of two corpora: the benchmark passages, as ``doc_id, text``."""
    return read_table(spark, directory, "benchmark", BENCHMARK).select(F.col("item_id").alias("doc_id"), "text")


def employees(spark: SparkSession, directory: str) -> DataFrame:
    """Customers as employees: ``id, name, age, salary``."""
    return read_table(spark, directory, "customer", CUSTOMER).select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("age"),
        F.col("c_acctbal").alias("salary"),
    )


def employee_lines(spark: SparkSession, directory: str) -> DataFrame:
    """Customers as delimited employee records: ``line``."""
    customers = read_table(spark, directory, "customer", CUSTOMER).select("c_name", "c_nationkey", "c_acctbal")
    return format_delimited(customers, customers.columns, fixed.EMPLOYEE_SEPARATOR)


def bids(spark: SparkSession, directory: str) -> DataFrame:
    """Events as bids: ``bid_id, auctionid, bid, bidtime, price, item``.

    An event has one amount, which is the bid. The price is the user's number: like a closing
    price it is the same for all bids of an auction, and it is not the bid.
    """
    return read_table(spark, directory, "events", EVENTS).select(
        F.col("event_id").alias("bid_id"),
        F.col("user_id").alias("auctionid"),
        F.col("value").alias("bid"),
        F.col("ts").alias("bidtime"),
        F.col("user_id").alias("price"),
        F.col("event_type").alias("item"),
    )


def line_bids(spark: SparkSession, directory: str) -> DataFrame:
    """Order lines as bids: ``auctionid, bid, price, item``."""
    return read_table(spark, directory, "lineitem", LINEITEM).select(
        F.col("l_orderkey").alias("auctionid"),
        F.col("l_extendedprice").alias("bid"),
        F.col("l_quantity").alias("price"),
        F.col("l_returnflag").alias("item"),
    )


# The column behind each field of a bid record, in record order.
LINEITEM_RECORD = [
    "l_orderkey",
    "l_extendedprice",
    "l_discount",
    "l_linestatus",
    "l_linenumber",
    "l_quantity",
    "l_tax",
    "l_returnflag",
    "l_linenumber",
]


EVENT_RECORD = [
    "user_id",
    "value",
    "value",
    "event_type",
    "user_id",
    "value",
    "user_id",
    "event_type",
    "user_id",
]


def _bid_lines(table: DataFrame, record: list[str]) -> DataFrame:
    columns = list(dict.fromkeys(record))
    return format_delimited(table.select(*columns), record, fixed.BID_SEPARATOR)


def lineitem_bid_lines(spark: SparkSession, directory: str) -> DataFrame:
    """Order lines as delimited bid records: ``line``."""
    return _bid_lines(read_table(spark, directory, "lineitem", LINEITEM), LINEITEM_RECORD)


def event_bid_lines(spark: SparkSession, directory: str) -> DataFrame:
    """Events as delimited bid records: ``line``."""
    return _bid_lines(read_table(spark, directory, "events", EVENTS), EVENT_RECORD)


def integers(spark: SparkSession, directory: str) -> DataFrame:
    """Part sizes: ``p_partkey, p_size``."""
    return read_table(spark, directory, "part", PART).select("p_partkey", "p_size")
