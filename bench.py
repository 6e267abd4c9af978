"""Wall-clock of the headline queries. Prints one JSON line.

BENCH_SF_DIR   table directory (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default 8)
BENCH_RUNS     timed runs per query after one warm-up; the median counts (default 3)
"""

import json
import os
import re
import statistics
import time

from lexibid.plans.queries import all_queries
from lexibid.sources.session import local_session

HEADLINE = [
    "text_lines",
    "tokens",
    "token_count",
    "words",
    "alpha_tokens",
    "wordcount_raw",
    "wordcount_clean",
    "wordcount_sink_roundtrip",
    "first_words",
    "unique_words",
    "vocab_only_in_a",
    "vocab_common",
    "corpus_summary",
    "filter_project",
    "delim_scan_employees",
    "delim_scan_bids",
    "delim_item_stats",
    "map_square",
    "bids_over_100",
    "auction_count",
    "auction_count_sql",
    "avg_bid_per_item",
    "avg_bids_per_item_sql",
    "lineitem_auction_count",
    "lineitem_bids_per_auction",
    "lineitem_item_stats",
    "lineitem_auction_stats",
]


def run(query, spark, directory):
    """Compute every row and column of the result without moving it anywhere."""
    start = time.perf_counter()
    query(spark, directory).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main():
    directory = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(cpus, "bench")
    queries = all_queries()
    seconds = {}
    for name in HEADLINE:
        run(queries[name], spark, directory)
        timed = [run(queries[name], spark, directory) for _ in range(runs)]
        seconds[name] = round(statistics.median(timed), 4)
    scale = re.search(r"sf([0-9.]+)", directory)
    print(
        json.dumps(
            {
                "metric": f"total wall-clock of {len(seconds)} headline queries",
                "value": round(sum(seconds.values()), 4),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else None,
                "cpus": cpus,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
