"""Semi-structured values as VARIANT: parsed once, read by path.

A JSON string column becomes a VARIANT column (``variant_column``), which is
stored and read like any other type; paths are then looked up in the binary
form, without parsing the text again. A path that is absent, or a value that is
not of the asked type, gives NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def variant_column(df: DataFrame, column: str) -> DataFrame:
    """``df`` with the JSON strings of ``column`` parsed; text that is not JSON becomes NULL."""
    return df.withColumn(column, F.try_parse_json(column))


def at(column: str | Column, path: str, data_type: str) -> Column:
    """The value at a path: ``details:a:b`` is ``at("details", "a.b", type)``."""
    return F.try_variant_get(column, path if path.startswith("$") else f"$.{path}", data_type)


def elements(column: str | Column, path: str) -> Column:
    """The elements of an array at a path, as VARIANTs; an absent array is empty."""
    return F.coalesce(at(column, path, "array<variant>"), F.array().cast("array<variant>"))


def shape(column: str | Column) -> Column:
    """Aggregate: the common schema of all values."""
    return F.schema_of_variant_agg(column)
