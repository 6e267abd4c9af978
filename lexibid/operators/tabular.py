"""Projections, filters, row maps, ordered heads and the schema report."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexibid import fixed


def square(df: DataFrame, column: str, name: str) -> DataFrame:
    """Adds ``column * column``. An int overflow is an error under ANSI mode, not a wrap."""
    return df.withColumn(name, F.col(column) * F.col(column))


def project(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*columns)


def well_paid(employees: DataFrame, floor: float = fixed.SALARY_FLOOR) -> DataFrame:
    """Names of the employees who get more than ``floor``: ``name``."""
    return employees.where(F.col("salary") > floor).select("name")


def well_paid_sql(employees: DataFrame, floor: float = fixed.SALARY_FLOOR) -> DataFrame:
    query = "SELECT name FROM {employees} WHERE salary > {floor}"
    return employees.sparkSession.sql(query, employees=employees, floor=floor)


def head(df: DataFrame, key: str, n: int = fixed.HEAD_ROWS) -> DataFrame:
    """The first ``n`` rows in key order: a top-n per task, then a top-n of those."""
    return df.orderBy(key).limit(n)


def schema_report(df: DataFrame) -> DataFrame:
    """One row per column: ``position, name, type, nullable, nulls``.

    ``nulls`` is counted over the whole table, in one pass for all columns.
    """
    nulls = df.agg(*(F.count_if(F.col(f.name).isNull()).alias(f"n{i}") for i, f in enumerate(df.schema)))
    report = F.array(
        *(
            F.struct(
                F.lit(i).alias("position"),
                F.lit(f.name).alias("name"),
                F.lit(f.dataType.simpleString()).alias("type"),
                F.lit(f.nullable).alias("nullable"),
                F.col(f"n{i}").alias("nulls"),
            )
            for i, f in enumerate(df.schema)
        )
    )
    return nulls.select(F.inline(report))
