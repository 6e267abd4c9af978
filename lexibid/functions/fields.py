"""Typed access to the fields of a split record, failing the job on bad records."""

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

INTEGERS = (T.IntegerType, T.LongType)
# Types a field can have, with a value that is never seen: see required_field.
UNSEEN = {"string": "''", "int": "0", "bigint": "0", "float": "0", "double": "0"}


def required_field(parts: str, index: int, field: T.StructField, last_typed: int) -> Column:
    """Field ``index`` of the array column ``parts``, cast to its type, or an error for the job.

    Does not depend on the session's ANSI mode. Trailing empty fields count as missing: up
    to ``last_typed``, the last field that is not a string, the casts see to it; after it, a
    string is there only if it or something after it is non-empty.
    """
    kind = field.dataType.simpleString()
    raw = f"get({parts}, {index})"
    if isinstance(field.dataType, T.StringType):
        value = raw
        if index > last_typed:
            rest = f"array_join(slice({parts}, {index + 1}, {2**31 - 1}), '')"
            empty_line = f"{index} = 0 AND size({parts}) = 1"
            value = f"CASE WHEN {rest} <> '' OR ({empty_line}) THEN {raw} END"
    elif isinstance(field.dataType, INTEGERS):
        # digits only: the cast alone would accept blanks around them
        value = f"CASE WHEN {raw} RLIKE r'\\A[+-]?[0-9]+\\z' THEN try_cast({raw} AS {kind}) END"
    else:
        value = f"try_cast({raw} AS {kind})"

    label = f"bad field {index} `{field.name}` ({kind}): ".replace("\\", "\\\\").replace("'", "\\'")
    error = f"raise_error(concat('{label}', coalesce({raw}, 'missing')))"
    # The last literal makes the column non-nullable, as declared.
    unseen = f"CAST({UNSEEN[kind]} AS {kind})"
    return F.expr(f"coalesce({value}, CAST({error} AS {kind}), {unseen})").alias(field.name)


def writable(value: Column, name: str, separator: str) -> Column:
    """A string as a field of a line, or an error for the job if no scan could read it back."""
    bad = F.contains(value, F.lit(separator)) | F.contains(value, F.lit("\n")) | F.contains(value, F.lit("\r"))
    error = F.raise_error(F.concat(F.lit(f"field `{name}` cannot be written: "), F.coalesce(value, F.lit("NULL"))))
    return F.when(value.isNull() | bad, error.cast("string")).otherwise(value)
