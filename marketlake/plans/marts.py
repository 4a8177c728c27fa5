"""Marts derived from the fact: current-day tables and their seeds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from marketlake import schemas
from marketlake.functions.market_cap import UNKNOWN_CLASS
from marketlake.operators.latest import latest_per_key
from marketlake.plans.metrics import metric_names


def as_current_day(bars: DataFrame) -> DataFrame:
    """Fact rows in the shape of the current-day table, not updated yet."""
    return bars.select(
        "ticker",
        "trade_date",
        F.col("close_price").alias("last_price"),
        "open_price",
        "high_price",
        "low_price",
        "volume",
        F.lit(None).cast("timestamp_ntz").alias("last_updated_ts"),
    )


def init_current_day(fact: DataFrame) -> DataFrame:
    """Seed rows: the latest bar of every ticker."""
    return as_current_day(latest_per_key(fact, ["ticker"], "trade_date"))


def init_metrics(baselines: DataFrame, details: DataFrame) -> DataFrame:
    """Seed of the metrics table: baselines, empty prices, market-cap class.

    No broadcast hint: Spark broadcasts the details only when their size allows it.
    """
    described = baselines.join(details.select("ticker", "market_cap_description"), "ticker", "left")
    empty = ("current_price", *metric_names((90, 365)))
    return described.select(
        "*",
        *(F.lit(None).cast("double").alias(c) for c in empty),
        F.lit(None).cast("timestamp_ntz").alias("last_updated_datetime"),
    ).withColumn(
        "market_cap_description", F.coalesce("market_cap_description", F.lit(UNKNOWN_CLASS))
    ).select(*schemas.METRICS.fieldNames())


def on_date(current_day: DataFrame, day: Column | None = None) -> DataFrame:
    """Rows of one date, by default the last: the table may still hold seeds of earlier ones."""
    last = current_day.agg(F.max("trade_date")).scalar() if day is None else day
    return current_day.where(F.col("trade_date") == last)
