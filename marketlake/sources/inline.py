"""Literal rows as a relation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from marketlake import schemas


def current_day_values(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """A handful of typed current-day records, for instance manual corrections."""
    return spark.createDataFrame(rows, schemas.CURRENT_DAY)
