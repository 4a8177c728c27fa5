"""Typed projections over text columns; bad fields and non-finite numbers become NULL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T


def finite(value: Column) -> Column:
    """The one policy for doubles: NaN and infinities are missing values (Spark sorts NaN
    above infinity, so one comparison excludes all three)."""
    return F.when(F.abs(value) < float("inf"), value)


def parse_field(text: Column, data_type: T.DataType) -> Column:
    if isinstance(data_type, T.StringType):
        return text
    if isinstance(data_type, T.DateType):
        return F.try_to_date(text, "yyyy-MM-dd")
    if isinstance(data_type, T.LongType):
        # Feeds write counts as 123 or 123.0; only the second form goes through double.
        return F.coalesce(text.try_cast("bigint"), text.try_cast("double").try_cast("bigint"))
    if isinstance(data_type, T.DoubleType):
        return finite(text.try_cast("double"))
    return text.try_cast(data_type)


def typed(df: DataFrame, schema: T.StructType) -> DataFrame:
    return df.select(*(parse_field(F.col(f.name), f.dataType).alias(f.name) for f in schema))
