"""CSV landing files: one folder of daily files, one of full history, one of details."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from marketlake import schemas
from marketlake.functions.casting import typed
from marketlake.functions.symbols import canonical_symbol


def _scan(spark: SparkSession, path: str, schema) -> DataFrame:
    # A given schema costs no inference pass; the header is still checked by name.
    return (
        spark.read.schema(schemas.as_text(schema))
        .option("header", True)
        .option("enforceSchema", False)
        .csv(path)
    )


def bars_path(root: str, ds: str | None) -> str:
    """Daily file of ``ds``, or the history when no date is given."""
    return f"{root}/daily/ds={ds}" if ds else f"{root}/history"


def read_bars(spark: SparkSession, root: str, ds: str | None = None) -> DataFrame:
    rows = typed(_scan(spark, bars_path(root, ds), schemas.STAGING), schemas.STAGING)
    return rows.withColumn("ticker", canonical_symbol(F.col("ticker")))


def read_details(spark: SparkSession, path: str) -> DataFrame:
    rows = typed(_scan(spark, path, schemas.DETAILS), schemas.DETAILS)
    return rows.withColumn("ticker", canonical_symbol(F.col("ticker")))


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_daily(bars: DataFrame, root: str) -> None:
    """Every day's file in one job. Rebalancing by day makes few files per day, and
    adaptive execution splits a day that is too large for one task."""
    (
        bars.withColumn("ds", F.col("snapshot_date"))
        .hint("rebalance", "ds")
        .write.mode("overwrite")
        .option("header", True)
        .partitionBy("ds")
        .csv(f"{root}/daily")
    )
