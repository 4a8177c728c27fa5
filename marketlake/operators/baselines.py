"""Trailing averages of the close, as of one date or rolling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from marketlake.functions.prices import exact, exact_mean, mean_of
from marketlake.functions.rounding import rounded

DEFAULT_WINDOWS = (90, 365)


def average_name(days: int) -> str:
    return f"close_price_avg_last_{days}_days"


def trailing_baselines(
    fact: DataFrame,
    windows: tuple[int, ...] = DEFAULT_WINDOWS,
    as_of: Column | None = None,
    closes: DataFrame | None = None,
) -> DataFrame:
    """Last close, and averages over the ``n`` calendar days that end at ``as_of``
    (default: the last date of the fact). One aggregation with partial sums.

    ``closes`` (ticker, close_price_last_day) gives the last closes where a mart has them:
    then only the dates of the longest window are read from the fact.
    """
    end = fact.agg(F.max("trade_date")).scalar() if as_of is None else as_of
    within = F.col("trade_date") <= end
    if closes is not None:
        within &= F.col("trade_date") > F.date_sub(end, max(windows))
    age = fact.where(within).withColumn("_age", F.datediff(end, "trade_date"))
    averages = [
        rounded(exact_mean(F.when(F.col("_age") < n, F.col("close_price"))), 4).alias(average_name(n))
        for n in windows
    ]
    if closes is not None:
        return closes.join(age.groupBy("ticker").agg(*averages), "ticker", "left")
    return age.groupBy("ticker").agg(
        F.max_by("close_price", "trade_date").alias("close_price_last_day"), *averages
    )


def rolling_averages(fact: DataFrame, windows: tuple[int, ...] = DEFAULT_WINDOWS) -> DataFrame:
    """Averages over the ``n`` calendar days up to and including each bar.

    A window of n days is the running total up to the bar minus the running total up to n
    days before. Running frames only ever grow, so each bar is added once per frame,
    whereas a sliding frame adds up all its bars again for every row; decimal totals make
    the difference exact.
    """
    by_day = Window.partitionBy("ticker").orderBy(F.unix_date("trade_date"))

    def running(aggregate: Column, days_before: int) -> Column:
        return aggregate.over(by_day.rangeBetween(Window.unboundedPreceding, -days_before))

    close = exact(F.col("close_price"))
    total, priced = F.sum(close), F.count(close)

    def average(days: int) -> Column:
        before = F.coalesce(running(total, days), F.lit(0))
        return mean_of(
            running(total, 0) - before, running(priced, 0) - running(priced, days)
        )

    return fact.select(
        "ticker", "trade_date", *(rounded(average(n), 4).alias(f"avg_{n}d") for n in windows)
    )
