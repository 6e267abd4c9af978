"""Questions about bids, in the DataFrame form.

Bids have at least ``auctionid``, ``item``, ``bid`` and ``price``. ``price`` is the closing
price of the auction, not the amount of the bid. "Bids per item" for min, max and avg means
bids per auction of that item. Averages of bids are sums of doubles, whose last digits depend on
how rows are spread over tasks; rounding hides that but for sums next to a rounding edge.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexibid import fixed
from lexibid.operators.counts import count_per_key, distinct_count


def _min_bid() -> Column:
    return F.min("bid").alias(fixed.MINIMUM_BID)


def _max_bid() -> Column:
    return F.max("bid").alias(fixed.MAXIMUM_BID)


def _avg_bid() -> Column:
    return F.round(F.avg("bid"), fixed.AVERAGE_PLACES).alias(fixed.AVERAGE_BID)


def auction_count(bids: DataFrame) -> DataFrame:
    return distinct_count(bids, "auctionid", fixed.AUCTIONS)


def bids_per_item(bids: DataFrame) -> DataFrame:
    return count_per_key(bids, "item", fixed.BIDS)


def min_bid_per_item(bids: DataFrame) -> DataFrame:
    return bids.groupBy("item").agg(_min_bid())


def max_bid_per_item(bids: DataFrame) -> DataFrame:
    return bids.groupBy("item").agg(_max_bid())


def avg_bid_per_item(bids: DataFrame) -> DataFrame:
    return bids.groupBy("item").agg(_avg_bid())


def bids_per_auction(bids: DataFrame) -> DataFrame:
    """Bids per item and auction. Keyed by both, so one hot item spreads over its auctions."""
    return bids.groupBy("item", "auctionid").agg(F.count(F.lit(1)).alias(fixed.BIDS))


def _over_auctions(bids: DataFrame, *answers: Column) -> DataFrame:
    return bids_per_auction(bids).groupBy("item").agg(*answers)


def min_bids_per_item(bids: DataFrame) -> DataFrame:
    return _over_auctions(bids, F.min(fixed.BIDS).alias(fixed.LEAST_BIDS))


def max_bids_per_item(bids: DataFrame) -> DataFrame:
    return _over_auctions(bids, F.max(fixed.BIDS).alias(fixed.MOST_BIDS))


def avg_bids_per_item(bids: DataFrame) -> DataFrame:
    return _over_auctions(bids, F.avg(fixed.BIDS).alias(fixed.AVERAGE_BIDS))


def bids_over_price_floor(bids: DataFrame, floor: float = fixed.PRICE_FLOOR) -> DataFrame:
    """All bids of auctions that closed above ``floor``."""
    return bids.where(F.col("price") > floor)


def item_stats(bids: DataFrame) -> DataFrame:
    """Count, min, max and avg bid per item in one pass."""
    return bids.groupBy("item").agg(F.count(F.lit(1)).alias(fixed.BIDS), _min_bid(), _max_bid(), _avg_bid())


def auction_stats(bids: DataFrame) -> DataFrame:
    """Min, max and avg number of bids per auction of each item in one pass."""
    return _over_auctions(
        bids,
        F.min(fixed.BIDS).alias(fixed.LEAST_BIDS),
        F.max(fixed.BIDS).alias(fixed.MOST_BIDS),
        F.avg(fixed.BIDS).alias(fixed.AVERAGE_BIDS),
    )
