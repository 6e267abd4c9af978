"""Scans of parquet tables and named temp views."""

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_table(spark: SparkSession, directory: str, name: str, schema: str) -> DataFrame:
    """The columns of a table named in ``schema`` (DDL).

    The files say themselves what they hold (one footer is read). A column that is missing or
    of another type is an error here, not a column of NULLs later. Only named columns are read.
    """
    stored = spark.read.parquet(f"{directory}/{name}.parquet")
    found = {field.name: field.dataType for field in stored.schema}
    declared = T.StructType.fromDDL(schema)
    for field in declared:
        if field.name not in found:
            raise ValueError(f"table {name} has no column {field.name}")
        if found[field.name] != field.dataType:
            kinds = f"{found[field.name].simpleString()}, not {field.dataType.simpleString()}"
            raise ValueError(f"column {field.name} of table {name} is {kinds}")
    return stored.select(*declared.names)


def temp_table(df: DataFrame, name: str | None = None) -> DataFrame:
    """Register ``df`` under a name for SQL and return the table of that name.

    Without a name it gets one of its own, so that calls do not replace each other's table.
    """
    name = name or f"table_{uuid.uuid4().hex}"
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)
