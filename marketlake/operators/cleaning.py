"""Row-level cleaning of daily bars."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def drop_incomplete(df: DataFrame) -> DataFrame:
    """Keep rows in which every field is present (NULL and NaN both count as absent)."""
    return df.na.drop("any")


def value_mark(columns: list[str]) -> Column:
    """A hash of values that tells (NULL, x) from (x, NULL): the null flags are hashed too."""
    return F.xxhash64(*columns, *(F.col(c).isNull() for c in columns))


def one_per_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key out of repeated loads, the one with the greatest hash of its values:
    the choice does not depend on the order of arrival. Copies collapse before the shuffle,
    in a hash aggregate (the maximum of a struct would have to sort the whole input)."""
    rest = [c for c in df.columns if c not in keys]
    marked = df.withColumn("_mark", value_mark(rest))
    kept = marked.groupBy(*keys).agg(*(F.max_by(c, "_mark").alias(c) for c in rest))
    return kept.select(*df.columns)
