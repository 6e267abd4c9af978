"""Values that decide results."""

from pyspark.sql import types as T

# The results depend on exactly these, so they are stated plainly here.

# Token and field separators.
TOKEN_SEPARATOR = " "
EMPLOYEE_SEPARATOR = ", "
BID_SEPARATOR = ","

# Which tokens count as words, and which characters are stripped from them. A clean word keeps
# the characters of one set and loses all others.
WORD_TOKEN = "[A-Za-z0-9.,]+"
WORD_STRIP = ".,"
ALPHA_TOKEN = "[A-Za-z.]+"
ALPHA_STRIP = "."
CLEAN_KEPT = "A-Za-z0-9"

# Thresholds (both strict) and the length of a "first rows" report.
SALARY_FLOOR = 3500
PRICE_FLOOR = 100
HEAD_ROWS = 10

# Names of the answers about bids, and the decimal places of an average of bids: sums of doubles
# differ beyond them with the order of addition.
AUCTIONS = "number_of_auctions"
BIDS = "number_of_bids"
MINIMUM_BID = "minimum_bid_price"
MAXIMUM_BID = "maximum_bid_price"
AVERAGE_BID = "average_bid_price"
LEAST_BIDS = "min_number_of_bids"
MOST_BIDS = "max_number_of_bids"
AVERAGE_BIDS = "avg_number_of_bids"
AVERAGE_PLACES = 6

# Record layouts of the delimited inputs; every field is required.
EMPLOYEE_SCHEMA = T.StructType(
    [
        T.StructField("name", T.StringType(), False),
        T.StructField("age", T.IntegerType(), False),
        T.StructField("salary", T.FloatType(), False),
    ]
)
BID_SCHEMA = T.StructType(
    [
        T.StructField("auctionid", T.LongType(), False),
        T.StructField("bid", T.FloatType(), False),
        T.StructField("bidtime", T.FloatType(), False),
        T.StructField("bidder", T.StringType(), False),
        T.StructField("bidderrate", T.IntegerType(), False),
        T.StructField("openbid", T.FloatType(), False),
        T.StructField("price", T.FloatType(), False),
        T.StructField("item", T.StringType(), False),
        T.StructField("daystolive", T.IntegerType(), False),
    ]
)
