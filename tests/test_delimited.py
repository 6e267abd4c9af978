"""Typed scans: golden files, record edge cases, failing on bad records."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import types as T

from lexibid.fixed import BID_SCHEMA, BID_SEPARATOR, EMPLOYEE_SCHEMA, EMPLOYEE_SEPARATOR
from lexibid.operators.tabular import head, project, schema_report, square, well_paid, well_paid_sql
from lexibid.sources.delimited import format_delimited, parse_delimited, read_delimited


@pytest.fixture
def parse(spark):
    def run(*lines, schema=EMPLOYEE_SCHEMA, separator=EMPLOYEE_SEPARATOR):
        df = spark.createDataFrame([(line,) for line in lines], "line string")
        return parse_delimited(df, schema, separator)

    return run


@pytest.fixture(scope="module")
def employees(spark, fixture_path):
    return read_delimited(spark, fixture_path("employees.txt"), EMPLOYEE_SCHEMA, EMPLOYEE_SEPARATOR)


def test_employees(employees):
    assert employees.schema == EMPLOYEE_SCHEMA
    rows = [tuple(r) for r in employees.collect()]
    assert [(n, a) for n, a, _ in rows] == [("Michael", 29), ("Andy", 30), ("Justin", 19)]
    assert [s for *_, s in rows] == [3000.300048828125, 2500.25, pytest.approx(4000.99, abs=1e-3)]
    assert rows[2][2] != 4000.99  # 32-bit


def test_well_paid_employees(employees):
    for operator in (well_paid, well_paid_sql):
        assert [r.name for r in operator(employees).collect()] == ["Justin"]
    assert project(employees, "age", "name").columns == ["age", "name"]
    assert [r.name for r in head(employees, "age", 2).collect()] == ["Justin", "Michael"]


def test_salary_floor_is_strict(parse):
    df = parse("a, 1, 3500", "b, 1, 3500.01", "c, 1, 3499.99")
    for operator in (well_paid, well_paid_sql):
        assert [r.name for r in operator(df).collect()] == ["b"]


def test_bids(spark, fixture_path):
    bids = read_delimited(spark, fixture_path("bids.csv"), BID_SCHEMA, BID_SEPARATOR)
    assert bids.schema == BID_SCHEMA
    rows = bids.collect()
    assert len(rows) == 7
    assert rows[5].bidderrate == -4 and rows[6].item == "phone" and rows[3].daystolive == 5


def test_surplus_fields_are_ignored(parse):
    assert [tuple(r) for r in parse("a, 1, 2.5, more, even more").collect()] == [("a", 1, 2.5)]


def test_blanks_and_separators_inside_fields(parse):
    assert [tuple(r) for r in parse(" a,b , +1, 2").collect()] == [(" a,b ", 1, 2.0)]
    assert [tuple(r) for r in parse(", 1, 2").collect()] == [("", 1, 2.0)]


BAD_EMPLOYEES = [
    "",
    "a",
    "a, 1",
    "a, 1, ",
    "a, , 2",
    "a, x, 2",
    "a, 1.0, 2",
    "a, 29 , 2",
    "a,  29, 2",
    "a, 2147483648, 2",
    "a, 1, two",
    "a,1,2",
]


@pytest.mark.parametrize("line", BAD_EMPLOYEES)
@pytest.mark.parametrize("ansi", ["true", "false"])
def test_bad_records_fail_the_job(spark, parse, line, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(PySparkException, match="bad field"):
            parse("ok, 1, 2", line).collect()
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


@pytest.mark.parametrize("line", ["a,b,,", "a,b", "a,,", ",,", ""])
def test_trailing_empty_strings_are_missing(parse, line):
    schema = T.StructType([T.StructField(n, T.StringType(), False) for n in "xyz"])
    with pytest.raises(PySparkException, match="bad field"):
        parse(line, schema=schema, separator=",").collect()


def test_inner_empty_strings_are_kept(parse):
    schema = T.StructType([T.StructField(n, T.StringType(), False) for n in "xyz"])
    assert [tuple(r) for r in parse(",,c", schema=schema, separator=",").collect()] == [("", "", "c")]
    surplus = parse("a,,,d", schema=schema, separator=",").collect()
    assert [tuple(r) for r in surplus] == [("a", "", "")]


def test_separator_is_literal(parse):
    schema = T.StructType([T.StructField("x", T.IntegerType()), T.StructField("y", T.LongType())])
    assert [tuple(r) for r in parse("1|2", schema=schema, separator="|").collect()] == [(1, 2)]


def test_unread_columns_are_not_checked(parse):
    """Columns that no result needs are pruned, and so is their check."""
    df = parse("a, old, 4000")
    assert [r.name for r in well_paid(df).collect()] == ["a"]
    with pytest.raises(PySparkException, match="bad field 1 `age`"):
        df.collect()


def test_format_is_the_inverse(spark, fixture_path):
    bids = read_delimited(spark, fixture_path("bids.csv"), BID_SCHEMA, BID_SEPARATOR)
    again = parse_delimited(format_delimited(bids, bids.columns, BID_SEPARATOR), BID_SCHEMA, BID_SEPARATOR)
    assert again.collect() == bids.collect()


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize("row", [("x", None), (None, 5), ("a, b", 5), ("a\nb", 5), ("a\rb", 5)])
def test_what_cannot_be_read_back_is_not_written(spark, row, ansi):
    df = spark.createDataFrame([row], "name string, age int")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(PySparkException, match="cannot be written"):
            format_delimited(df, df.columns, ", ").collect()
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_schema_report(spark):
    df = spark.createDataFrame([(1, None), (2, "x"), (3, None)], "a int not null, b string")
    assert [tuple(r) for r in schema_report(df).orderBy("position").collect()] == [
        (0, "a", "int", False, 0),
        (1, "b", "string", True, 2),
    ]


def test_schema_report_of_a_scan_is_non_null(employees):
    report = schema_report(employees).orderBy("position").collect()
    assert [(r.name, r.type, r.nullable, r.nulls) for r in report] == [
        ("name", "string", False, 0),
        ("age", "int", False, 0),
        ("salary", "float", False, 0),
    ]


def test_square(spark):
    df = spark.createDataFrame([(x,) for x in (1, 2, 3, 4)], "x int")
    assert [r.squared for r in square(df, "x", "squared").collect()] == [1, 4, 9, 16]


def test_square_overflow_is_an_error(spark):
    df = spark.createDataFrame([(65536,)], "x int")
    with pytest.raises(PySparkException, match="ARITHMETIC_OVERFLOW"):
        square(df, "x", "squared").collect()
