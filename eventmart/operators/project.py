"""Typed projection driven by a schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def typed_column(field: StructField) -> Column:
    """The column as the field's type; a value that does not fit becomes null."""
    column = F.col(f"`{field.name}`")
    if not isinstance(field.dataType, StringType):
        column = column.try_cast(field.dataType)
    return column.alias(field.name)


def typed_select(df: DataFrame, schema: StructType) -> DataFrame:
    """Selects the schema's columns, each in its declared type. One narrow projection."""
    return df.select(*[typed_column(f) for f in schema])
