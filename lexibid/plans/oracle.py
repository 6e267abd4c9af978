"""DuckDB SQL for every query, written independently of the Spark operators."""

from lexibid import fixed

DOCUMENTS = "SELECT doc_id, text FROM documents"
CORPUS_A = DOCUMENTS
CORPUS_B = "SELECT item_id AS doc_id, text FROM benchmark"

# The lists behind lines and tokens.
_LINES = r"regexp_split_to_array(regexp_replace(text, '(\r\n|\n|\r)\z', ''), '\r\n|\n|\r')"
_TOKENS = """CASE WHEN line <> '' AND rtrim(line, ' ') = '' THEN []::varchar[]
    ELSE string_split(rtrim(line, ' '), ' ') END"""


def lines(texts: str) -> str:
    return f"SELECT unnest({_LINES}) AS line FROM ({texts}) WHERE text <> ''"


def tokens(texts: str) -> str:
    return f"SELECT unnest({_TOKENS}) AS tok FROM ({lines(texts)})"


def words(texts: str) -> str:
    return f"""SELECT regexp_replace(lower(tok), '[.,]', '', 'g') AS word FROM ({tokens(texts)})
        WHERE regexp_full_match(tok, '[A-Za-z0-9.,]+')"""


def alpha_tokens(texts: str) -> str:
    return f"""SELECT regexp_replace(tok, '[^A-Za-z0-9]', '', 'g') AS word FROM ({tokens(texts)})
        WHERE regexp_full_match(tok, '[A-Za-z.]+')"""


def clean_words(texts: str) -> str:
    return f"""SELECT word FROM (
            SELECT lower(regexp_replace(tok, '[^A-Za-z0-9]', '', 'g')) AS word FROM ({tokens(texts)})
        ) WHERE word <> ''"""


def first_words(texts: str) -> str:
    return f"""
        WITH numbered_lines AS (
            SELECT doc_id, unnest(ls) AS line, (generate_subscripts(ls, 1) - 1)::int AS ln
            FROM (SELECT doc_id, {_LINES} AS ls FROM ({texts}) WHERE text <> '')
        ), numbered_tokens AS (
            SELECT doc_id, ln, unnest(ts) AS tok, (generate_subscripts(ts, 1) - 1)::int AS pos
            FROM (SELECT doc_id, ln, {_TOKENS} AS ts FROM numbered_lines)
        )
        SELECT doc_id, ln, pos, regexp_replace(lower(tok), '[.,]', '', 'g') AS word
        FROM numbered_tokens WHERE regexp_full_match(tok, '[A-Za-z0-9.,]+')
        ORDER BY doc_id, ln, pos LIMIT 10"""


def count_of(query: str, name: str) -> str:
    return f"SELECT count(*) AS {name} FROM ({query})"


def distinct(query: str) -> str:
    return f"SELECT DISTINCT * FROM ({query})"


RAW_COUNTS = f"SELECT tok, count(*) AS cnt FROM ({tokens(DOCUMENTS)}) GROUP BY tok"
CLEAN_COUNTS = f"SELECT word, count(*) AS cnt FROM ({clean_words(DOCUMENTS)}) GROUP BY word ORDER BY word"
ONLY_IN_A = f"({words(CORPUS_A)}) EXCEPT ({words(CORPUS_B)})"
COMMON = f"({words(CORPUS_A)}) INTERSECT ({words(CORPUS_B)})"

EMPLOYEES = "SELECT c_custkey AS id, c_name AS name, c_nationkey AS age, c_acctbal AS salary FROM customer"
PARSED_EMPLOYEES = "SELECT c_name AS name, c_nationkey AS age, c_acctbal::float AS salary FROM customer"

BIDS = """SELECT event_id AS bid_id, user_id AS auctionid, value AS bid, ts AS bidtime, user_id AS price,
    event_type AS item FROM events"""
LINE_BIDS = """SELECT l_orderkey AS auctionid, l_extendedprice AS bid, l_quantity AS price,
    l_returnflag AS item FROM lineitem"""
PARSED_BIDS = """SELECT l_orderkey AS auctionid, l_extendedprice::float AS bid, l_discount::float AS bidtime,
    l_linestatus AS bidder, l_linenumber AS bidderrate, l_quantity::float AS openbid, l_tax::float AS price,
    l_returnflag AS item, l_linenumber AS daystolive FROM lineitem"""

PARSED_EVENT_BIDS = """SELECT user_id AS auctionid, value::float AS bid, value::float AS bidtime,
    event_type AS bidder, user_id::int AS bidderrate, value::float AS openbid, user_id::float AS price,
    event_type AS item, user_id::int AS daystolive FROM events"""


def per_item(bids: str, measures: str) -> str:
    return f"SELECT item, {measures} FROM ({bids}) GROUP BY item"


def per_auction(bids: str) -> str:
    return f"SELECT item, auctionid, count(*) AS {fixed.BIDS} FROM ({bids}) GROUP BY item, auctionid"


BID_MEASURES = {
    "bids_per_item": f"count(*) AS {fixed.BIDS}",
    "min_bid_per_item": f"min(bid) AS {fixed.MINIMUM_BID}",
    "max_bid_per_item": f"max(bid) AS {fixed.MAXIMUM_BID}",
    "avg_bid_per_item": f"round(avg(bid), {fixed.AVERAGE_PLACES}) AS {fixed.AVERAGE_BID}",
}
AUCTION_MEASURES = {
    "min_bids_per_item": f"min({fixed.BIDS}) AS {fixed.LEAST_BIDS}",
    "max_bids_per_item": f"max({fixed.BIDS}) AS {fixed.MOST_BIDS}",
    "avg_bids_per_item": f"avg({fixed.BIDS}) AS {fixed.AVERAGE_BIDS}",
}
ALL_BID_MEASURES = ", ".join(BID_MEASURES.values())
ALL_AUCTION_MEASURES = ", ".join(AUCTION_MEASURES.values())

BID_COLUMNS = {
    "bid_id": "bigint",
    "auctionid": "bigint",
    "bid": "double",
    "bidtime": "timestamp_ntz",
    "price": "bigint",
    "item": "string",
}
BIDS_SCHEMA = " UNION ALL ".join(
    f"""SELECT {i}::int AS position, '{name}' AS name, '{kind}' AS type, true AS nullable,
        count(*) - count({name}) AS nulls FROM ({BIDS})"""
    for i, (name, kind) in enumerate(BID_COLUMNS.items())
)

CORPUS_SUMMARY = f"""SELECT
    ({count_of(tokens(CORPUS_A), "n")}) AS tokens_a,
    ({count_of(tokens(CORPUS_B), "n")}) AS tokens_b,
    ({count_of(words(CORPUS_A), "n")}) AS words_a,
    ({count_of(words(CORPUS_B), "n")}) AS words_b,
    ({count_of(distinct(words(CORPUS_A)), "n")}) AS unique_words_a,
    ({count_of(distinct(words(CORPUS_B)), "n")}) AS unique_words_b,
    ({count_of(ONLY_IN_A, "n")}) AS only_in_a,
    ({count_of(COMMON, "n")}) AS common"""


def all_oracles() -> dict[str, str]:
    oracles = {
        "text_lines": lines(DOCUMENTS),
        "text_file_lines": lines(DOCUMENTS),
        "tokens": tokens(DOCUMENTS),
        "alpha_tokens": alpha_tokens(DOCUMENTS),
        "token_count": count_of(tokens(DOCUMENTS), "tokens"),
        "token_count_a": count_of(tokens(CORPUS_A), "tokens"),
        "token_count_b": count_of(tokens(CORPUS_B), "tokens"),
        "wordcount_raw": RAW_COUNTS,
        "wordcount_clean": CLEAN_COUNTS,
        "wordcount_raw_sink_roundtrip": RAW_COUNTS,
        "wordcount_sink_roundtrip": CLEAN_COUNTS,
        "vocab_only_in_a": ONLY_IN_A,
        "vocab_only_in_a_count": count_of(ONLY_IN_A, "only_in_a"),
        "vocab_common": COMMON,
        "vocab_common_count": count_of(COMMON, "common"),
        "corpus_summary": CORPUS_SUMMARY,
        "map_square": "SELECT p_partkey, p_size * p_size AS squared FROM part",
        "employees_project": f"SELECT name, age, salary FROM ({EMPLOYEES})",
        "head_employees": f"SELECT * FROM ({EMPLOYEES}) ORDER BY id LIMIT 10",
        "filter_project": f"SELECT name FROM ({EMPLOYEES}) WHERE salary > 3500",
        "filter_project_sql": f"SELECT name FROM ({EMPLOYEES}) WHERE salary > 3500",
        "delim_scan_employees": PARSED_EMPLOYEES,
        "delim_file_scan_employees": PARSED_EMPLOYEES,
        "delim_file_scan_bids": PARSED_BIDS,
        "delim_filter_project": f"SELECT name FROM ({PARSED_EMPLOYEES}) WHERE salary > 3500",
        "delim_filter_project_sql": f"SELECT name FROM ({PARSED_EMPLOYEES}) WHERE salary > 3500",
        "delim_scan_bids": PARSED_BIDS,
        "delim_auction_count": f"SELECT count(DISTINCT auctionid) AS {fixed.AUCTIONS} FROM ({PARSED_BIDS})",
        "delim_item_stats": per_item(PARSED_BIDS, ALL_BID_MEASURES),
        "delim_auction_stats": per_item(per_auction(PARSED_BIDS), ALL_AUCTION_MEASURES),
        "delim_bids_over_100": f"SELECT * FROM ({PARSED_EVENT_BIDS}) WHERE price > 100",
        "delim_bids_over_100_sql": f"SELECT * FROM ({PARSED_EVENT_BIDS}) WHERE price > 100",
        "bids_schema": BIDS_SCHEMA,
        "bids_project": f"SELECT auctionid, bid, bidtime, item FROM ({BIDS})",
        "bids_temp_table": BIDS,
        "head_bids": f"SELECT * FROM ({BIDS}) ORDER BY bid_id LIMIT 10",
        "bids_per_auction": per_auction(BIDS),
        "item_stats": per_item(BIDS, ALL_BID_MEASURES),
        "auction_stats": per_item(per_auction(BIDS), ALL_AUCTION_MEASURES),
        "lineitem_auction_count": f"SELECT count(DISTINCT auctionid) AS {fixed.AUCTIONS} FROM ({LINE_BIDS})",
        "lineitem_bids_per_auction": per_auction(LINE_BIDS),
        "lineitem_item_stats": per_item(LINE_BIDS, ALL_BID_MEASURES),
        "lineitem_auction_stats": per_item(per_auction(LINE_BIDS), ALL_AUCTION_MEASURES),
        "auction_count": f"SELECT count(DISTINCT auctionid) AS {fixed.AUCTIONS} FROM ({BIDS})",
        "bids_over_100": f"SELECT * FROM ({BIDS}) WHERE price > 100",
    }
    oracles |= {name: per_item(BIDS, measure) for name, measure in BID_MEASURES.items()}
    oracles |= {name: per_item(per_auction(BIDS), measure) for name, measure in AUCTION_MEASURES.items()}
    for name in ["auction_count", "bids_over_100", *BID_MEASURES, *AUCTION_MEASURES]:
        oracles[f"{name}_sql"] = oracles[name]
    for suffix, texts in {"": CORPUS_A, "_b": CORPUS_B}.items():
        oracles[f"words{suffix}"] = words(texts)
        oracles[f"first_words{suffix}"] = first_words(texts)
        oracles[f"word_total{suffix}"] = count_of(words(texts), "words")
        oracles[f"unique_words{suffix}"] = distinct(words(texts))
        oracles[f"unique_word_total{suffix}"] = count_of(distinct(words(texts)), "unique_words")
    return oracles
