"""The same questions about bids, asked in Spark SQL.

Each call registers its bids as a temp view under a name of its own (``{bids}``), so calls
cannot see or replace each other's table.
"""

from pyspark.sql import DataFrame

from lexibid import fixed

_PER_AUCTION = f"""
    WITH per_auction AS (
        SELECT item, auctionid, count(*) AS {fixed.BIDS}
        FROM {{bids}}
        GROUP BY item, auctionid
    )
"""


def _ask(bids: DataFrame, query: str) -> DataFrame:
    return bids.sparkSession.sql(query, bids=bids)


def _per_item(bids: DataFrame, answer: str) -> DataFrame:
    return _ask(bids, f"SELECT item, {answer} FROM {{bids}} GROUP BY item")


def _over_auctions(bids: DataFrame, answer: str) -> DataFrame:
    return _ask(bids, f"{_PER_AUCTION} SELECT item, {answer} FROM per_auction GROUP BY item")


def auction_count(bids: DataFrame) -> DataFrame:
    return _ask(bids, f"SELECT count(DISTINCT auctionid) AS {fixed.AUCTIONS} FROM {{bids}}")


def bids_per_item(bids: DataFrame) -> DataFrame:
    return _per_item(bids, f"count(*) AS {fixed.BIDS}")


def min_bid_per_item(bids: DataFrame) -> DataFrame:
    return _per_item(bids, f"min(bid) AS {fixed.MINIMUM_BID}")


def max_bid_per_item(bids: DataFrame) -> DataFrame:
    return _per_item(bids, f"max(bid) AS {fixed.MAXIMUM_BID}")


def avg_bid_per_item(bids: DataFrame) -> DataFrame:
    return _per_item(bids, f"round(avg(bid), {fixed.AVERAGE_PLACES}) AS {fixed.AVERAGE_BID}")


def min_bids_per_item(bids: DataFrame) -> DataFrame:
    return _over_auctions(bids, f"min({fixed.BIDS}) AS {fixed.LEAST_BIDS}")


def max_bids_per_item(bids: DataFrame) -> DataFrame:
    return _over_auctions(bids, f"max({fixed.BIDS}) AS {fixed.MOST_BIDS}")


def avg_bids_per_item(bids: DataFrame) -> DataFrame:
    return _over_auctions(bids, f"avg({fixed.BIDS}) AS {fixed.AVERAGE_BIDS}")


def bids_over_price_floor(bids: DataFrame, floor: float = fixed.PRICE_FLOOR) -> DataFrame:
    return bids.sparkSession.sql("SELECT * FROM {bids} WHERE price > {floor}", bids=bids, floor=floor)
