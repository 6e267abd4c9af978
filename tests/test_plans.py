"""What the plans must and must not contain."""

import re

import pytest

from lexibid.plans import bindings
from lexibid.plans.queries import all_queries
from lexibid.operators import auctions, tabular
from lexibid.sources.tables import read_table, temp_table

SF_DIR = "/root/testdata/sf0.001"
QUERIES = all_queries()
# These write files when called, so they are left to the oracle tests.
WRITING = {q for q in QUERIES if "_sink_" in q or "_file_" in q}
LAZY = sorted(set(QUERIES) - WRITING)


@pytest.mark.parametrize("name", LAZY)
def test_no_python_and_no_pairwise_joins(spark, plan, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    for forbidden in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin", "ObjectHashAggregate"):
        assert forbidden not in text


@pytest.mark.parametrize(
    ("name", "pushed", "columns"),
    [
        ("filter_project", "GreaterThan(c_acctbal,3500.0)", "c_name:string,c_acctbal:double"),
        ("filter_project_sql", "GreaterThan(c_acctbal,3500.0)", "c_name:string,c_acctbal:double"),
        ("words", "[]", "text:string"),
        ("bids_per_item", "[]", "event_type:string"),
        ("avg_bid_per_item_sql", "[]", "event_type:string,value:double"),
        ("lineitem_auction_stats", "[]", "l_orderkey:bigint,l_returnflag:string"),
        ("wordcount_clean", "[]", "text:string"),
    ],
)
def test_pushdown_and_pruning(spark, plan, name, pushed, columns):
    text = plan(QUERIES[name](spark, SF_DIR))
    assert pushed in text.split("PushedFilters: ")[1]
    assert f"ReadSchema: struct<{columns}>" in text


def test_price_filter_reaches_the_scan(spark, plan):
    for name in ("bids_over_100", "bids_over_100_sql"):
        assert "GreaterThan(user_id,100)" in plan(QUERIES[name](spark, SF_DIR))


@pytest.mark.parametrize(
    ("name", "shuffles"),
    [
        ("wordcount_raw", 1),
        ("wordcount_clean", 2),
        ("unique_words", 1),
        ("vocab_only_in_a", 1),
        ("vocab_common", 1),
        ("corpus_summary", 2),
        ("item_stats", 1),
        ("auction_stats", 2),
        ("token_count", 1),
        ("word_total", 1),
        ("first_words", 0),
        ("filter_project", 0),
        ("head_bids", 0),
        ("delim_scan_bids", 0),
    ],
)
def test_number_of_shuffles(spark, plan, name, shuffles):
    text = plan(QUERIES[name](spark, SF_DIR))
    assert text.count("Exchange ") == shuffles and "REPARTITION" not in text


@pytest.mark.parametrize("name", ["token_count", "token_count_b", "word_total", "word_total_b"])
def test_totals_make_no_token_rows(spark, plan, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    assert text.count("Generate explode") == (1 if name.startswith("token") else 0)  # lines only


@pytest.mark.parametrize("name", ["wordcount_raw", "vocab_common", "item_stats", "auction_stats"])
def test_counts_combine_before_the_shuffle(spark, plan, name):
    assert "partial_" in plan(QUERIES[name](spark, SF_DIR))


@pytest.mark.parametrize(
    "name", ["tokens", "words", "wordcount_clean", "corpus_summary", "delim_scan_bids", "auction_stats"]
)
def test_rows_stay_in_generated_code(spark, plan, name):
    df = QUERIES[name](spark, SF_DIR)
    df.collect()
    final = plan(df).split("== Initial Plan ==")[0]
    steps = re.findall(r"^[\s:+-]*(.*?)(?:Project|Filter|Generate|HashAggregate|Sort) ?[\[(e]", final, re.M)
    assert steps and all(step.startswith("*(") for step in steps)


def test_one_split_per_delimited_line(spark, plan):
    assert plan(QUERIES["delim_scan_bids"](spark, SF_DIR)).count("split(") == 1


def test_first_words_bound_reaches_the_scan(spark, plan):
    assert "LessThanOrEqual(doc_id,ScalarSubquery" in plan(QUERIES["first_words"](spark, SF_DIR))


@pytest.mark.parametrize("name", ["documents", "benchmark", "customer", "events", "lineitem", "part"])
def test_declared_columns_are_those_of_the_files(spark, name):
    declared = read_table(spark, SF_DIR, name, getattr(bindings, name.upper()))
    stored = spark.read.parquet(f"{SF_DIR}/{name}.parquet").select(*declared.columns)
    assert declared.schema == stored.schema


def test_a_missing_or_changed_column_is_an_error(spark, tmp_path):
    stored = spark.createDataFrame([(1, "a")], "doc_id bigint, body string")
    stored.write.parquet(str(tmp_path / "documents.parquet"))
    with pytest.raises(ValueError, match="documents has no column text"):
        QUERIES["wordcount_clean"](spark, str(tmp_path))
    with pytest.raises(ValueError, match="doc_id of table documents is bigint, not int"):
        read_table(spark, str(tmp_path), "documents", "doc_id int")


def test_price_and_bid_are_told_apart(spark):
    """The price floor asks for another column than the bid: swapping them changes the answer."""
    bids = bindings.bids(spark, SF_DIR).select("bid_id", "bid", "price")
    swapped = bids.toDF("bid_id", "price", "bid")
    over = auctions.bids_over_price_floor
    assert over(bids).count() != over(swapped).count()


def test_thresholds_are_arguments(spark):
    people = spark.createDataFrame([("a", 10.0), ("b", 20.0)], "name string, salary double")
    for operator in (tabular.well_paid, tabular.well_paid_sql):
        assert [r.name for r in operator(people, 15).collect()] == ["b"]


def test_temp_tables_have_names_of_their_own(spark):
    spark.range(3).createOrReplaceTempView("lexibid_bids")
    first, second = temp_table(spark.range(5)), temp_table(spark.range(7))
    assert (first.count(), second.count(), spark.table("lexibid_bids").count()) == (5, 7, 3)


def test_temp_table_can_be_queried_by_name(spark):
    df = temp_table(spark.range(5), "some_numbers")
    assert df.count() == 5
    assert spark.sql("SELECT sum(id) AS s FROM some_numbers").first().s == 10


def test_totals_agree(spark):
    """Counts of the parts add up to counts of the whole."""
    run = {n: QUERIES[n](spark, SF_DIR) for n in LAZY}
    total = lambda n, c: run[n].agg({c: "sum"}).first()[0]
    one = lambda n: run[n].first()[0]
    assert total("wordcount_raw", "cnt") == one("token_count")
    assert total("wordcount_clean", "cnt") <= one("token_count")
    assert one("unique_word_total") == one("vocab_only_in_a_count") + one("vocab_common_count")
    assert total("bids_per_item", "number_of_bids") == run["bids_project"].count()
    assert total("bids_per_auction", "number_of_bids") == run["bids_project"].count()
    summary = run["corpus_summary"].first()
    assert summary.tokens_a == one("token_count_a") and summary.tokens_b == one("token_count_b")
    assert summary.words_a == one("word_total") and summary.words_b == one("word_total_b")
    assert summary.unique_words_a == one("unique_word_total")
    assert summary.unique_words_b == one("unique_word_total_b")
    assert summary.only_in_a == one("vocab_only_in_a_count") and summary.common == one("vocab_common_count")
