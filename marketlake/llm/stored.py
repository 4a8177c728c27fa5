"""Intermediate tables in the shared folder, so that a lost executor costs no earlier stage."""

from __future__ import annotations

from pyspark.sql import DataFrame

from marketlake.session import fresh_path


def stored(frame: DataFrame, stem: str) -> DataFrame:
    """Write a frame and read it back: its plan starts anew from the written files."""
    spark = frame.sparkSession
    path = fresh_path(spark, stem)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)
