"""Per-ticker price history.

The fact holds one row per (ticker, trade_date), so a group is never longer than the
number of trading dates, however hot its ticker was in the raw data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def ordered_closes() -> Column:
    """Closes in date order. A struct keeps NULL closes, which a bare collect drops; the
    leading flag puts undated rows last."""
    entry = F.struct(F.col("trade_date").isNull().alias("undated"), "trade_date", "close_price")
    return F.sort_array(F.collect_list(entry))["close_price"]


def cumulative_prices(fact: DataFrame) -> DataFrame:
    return fact.groupBy("ticker").agg(
        ordered_closes().alias("price_history"),
        F.max("trade_date").alias("last_updated"),
    )


def append_day(dim: DataFrame, day: DataFrame) -> DataFrame:
    """The daily dimension after one more date, later than all that it holds: one row per
    ticker is joined with one partition of the fact instead of aggregating every history."""
    bars = day.select("ticker", "close_price", "trade_date", F.lit(True).alias("_new"))
    close = F.when(F.col("_new"), F.array("close_price"))
    none = F.array().cast("array<double>")
    return dim.join(bars, "ticker", "full_outer").select(
        "ticker",
        F.concat(F.coalesce("price_history", none), F.coalesce(close, none)).alias("price_history"),
        F.when(F.col("_new"), F.col("close_price")).otherwise(F.col("latest_price")).alias("latest_price"),
        F.least("historic_low", "close_price").alias("historic_low"),
        F.greatest("historic_high", "close_price").alias("historic_high"),
        F.coalesce("trade_date", "last_updated").alias("last_updated"),
    )


def append_days(dim: DataFrame, bars: DataFrame) -> DataFrame:
    """The same for any number of later dates: their bars alone are aggregated, and each
    ticker's row is joined with what they add."""
    added = dim_daily(bars)
    both = dim.alias("d").join(added.alias("a"), "ticker", "full_outer")
    none = F.array().cast("array<double>")
    new = F.col("a.last_updated").isNotNull()
    return both.select(
        "ticker",
        F.concat(F.coalesce("d.price_history", none), F.coalesce("a.price_history", none)).alias("price_history"),
        F.when(new, F.col("a.latest_price")).otherwise(F.col("d.latest_price")).alias("latest_price"),
        F.least("d.historic_low", "a.historic_low").alias("historic_low"),
        F.greatest("d.historic_high", "a.historic_high").alias("historic_high"),
        F.coalesce("a.last_updated", "d.last_updated").alias("last_updated"),
    )


def dim_daily(fact: DataFrame) -> DataFrame:
    """History, latest close, range and last date, all in one pass and one sort."""
    return fact.groupBy("ticker").agg(
        ordered_closes().alias("price_history"),
        F.max_by("close_price", "trade_date").alias("latest_price"),
        F.min("close_price").alias("historic_low"),
        F.max("close_price").alias("historic_high"),
        F.max("trade_date").alias("last_updated"),
    )
