"""Keyed merges as joins, for tables whose format has no row-level MERGE."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def _checked_source(source: DataFrame, keys: list[str]) -> DataFrame:
    """Source columns under ``s_`` names with a ``s_hit`` flag; a repeated key raises.

    The check groups on the join keys, so its shuffle serves the join as well.
    """
    values = [c for c in source.columns if c not in keys]
    grouped = source.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("s_copies"), *(F.any_value(c).alias(f"s_{c}") for c in values)
    )
    repeated = F.raise_error(
        F.concat(F.lit("merge source repeats key "), F.to_json(F.struct(*keys)))
    ).cast("boolean")
    hit = F.when(F.col("s_copies") > 1, repeated).otherwise(F.lit(True))
    return grouped.withColumn("s_hit", hit).drop("s_copies")


def _accepts(target: DataFrame, source: DataFrame, newer_only: str | None) -> Column:
    """Whether a matched row is overwritten: always (last writer wins), or only when the
    incoming row is not older."""
    hit = F.col("s_hit").isNotNull()
    if newer_only is None:
        return hit
    stored, incoming = F.col(newer_only), F.col(f"s_{newer_only}")
    return hit & (stored.isNull() | (incoming >= stored))


def merge_update(
    target: DataFrame, source: DataFrame, keys: list[str], newer_only: str | None = None
) -> DataFrame:
    """Matched rows take the source's columns; unmatched source rows are dropped."""
    updated = set(source.columns) - set(keys)
    joined = target.join(_checked_source(source, keys), keys, "left")
    take = _accepts(target, source, newer_only)
    return joined.select(
        *(
            F.when(take, F.col(f"s_{c}")).otherwise(F.col(c)).alias(c) if c in updated else F.col(c)
            for c in target.columns
        )
    )


def merge_upsert(
    target: DataFrame, source: DataFrame, keys: list[str], newer_only: str | None = None
) -> DataFrame:
    """Matched rows take the source's columns; unmatched source rows are inserted.

    A presence flag decides, not COALESCE: a NULL in the source overwrites.
    """
    updated = set(source.columns) - set(keys)
    known = target.withColumn("t_hit", F.lit(True))
    joined = known.join(_checked_source(source, keys), keys, "full_outer")
    take = F.col("t_hit").isNull() | _accepts(target, source, newer_only)
    return joined.select(
        *(
            F.when(take, F.col(f"s_{c}")).otherwise(F.col(c)).alias(c) if c in updated else F.col(c)
            for c in target.columns
        )
    )
