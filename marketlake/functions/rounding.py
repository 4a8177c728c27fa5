"""Rounding of doubles."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def rounded(value: Column, places: int) -> Column:
    """Round the scaled double, halves away from zero, as SQL engines do. Spark's own
    two-argument form rounds the shortest decimal text and differs on some halves."""
    factor = float(10**places)
    return F.round(value * factor) / factor
