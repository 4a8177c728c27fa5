"""Dashboard reports, each a function of tables and filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from marketlake.functions.casting import finite
from marketlake.functions.prices import exact_dollar_volume, exact_mean, pct_return
from marketlake.functions.rounding import rounded


def first_last_close(
    fact: DataFrame, first: Column | None = None, last: Column | None = None
) -> DataFrame:
    """Closes on the first and the last date of the whole fact, for tickers with both.

    One scan and one aggregation: the date bounds are scalar subqueries (pass them when a
    cheaper source knows them), the filter leaves two dates, and both closes come out of
    the same group.
    """
    start = fact.agg(F.min("trade_date")).scalar() if first is None else first
    end = fact.agg(F.max("trade_date")).scalar() if last is None else last
    day = F.col("trade_date")
    edges = fact.where((day == start) | (day == end)).select(
        "ticker", "close_price", (day == start).alias("is_first"), (day == end).alias("is_last")
    )
    both = edges.groupBy("ticker").agg(
        F.max(F.when(F.col("is_first"), F.col("close_price"))).alias("earliest_close"),
        F.max(F.when(F.col("is_last"), F.col("close_price"))).alias("latest_close"),
        F.max("is_first").alias("has_first"),
        F.max("is_last").alias("has_last"),
    )
    return both.where("has_first AND has_last").drop("has_first", "has_last")


def _returns(edges: DataFrame, details: DataFrame) -> DataFrame:
    change = finite(pct_return(F.col("latest_close"), F.col("earliest_close")))
    return details.join(edges, "ticker").withColumn("return_pct", change)


def sector_performance(edges: DataFrame, details: DataFrame) -> DataFrame:
    average = rounded(exact_mean(F.col("return_pct")), 2).alias("avg_return_pct")
    by_sector = _returns(edges, details.select("ticker", "sector")).groupBy("sector").agg(average)
    return by_sector.orderBy(F.desc("avg_return_pct"), "sector")


def stock_ranking(
    edges: DataFrame,
    details: DataFrame,
    sectors: Sequence[str] = (),
    cap_classes: Sequence[str] = (),
    limit: int = 50,
) -> DataFrame:
    """Best total returns, optionally of some sectors and market-cap classes only."""
    chosen = filter_details(details, sectors, cap_classes)
    ranked = _returns(edges, chosen.select("ticker", "company_name", "sector")).select(
        "ticker",
        "company_name",
        "sector",
        rounded(F.col("latest_close"), 2).alias("latest_close"),
        rounded(F.col("return_pct"), 2).alias("total_return_pct"),
    )
    return ranked.orderBy(F.desc_nulls_last("total_return_pct"), "ticker").limit(limit)


def filter_details(
    details: DataFrame, sectors: Sequence[str] = (), cap_classes: Sequence[str] = ()
) -> DataFrame:
    """Dashboard filters; an empty list does not restrict."""
    if sectors:
        details = details.where(F.col("sector").isin(*sectors))
    if cap_classes:
        details = details.where(F.col("market_cap_description").isin(*cap_classes))
    return details


def of_tickers(rows: DataFrame, details: DataFrame) -> DataFrame:
    """Rows of the tickers that are left in (filtered) details."""
    return rows.join(details.select("ticker"), "ticker", "left_semi")


def market_trend(fact: DataFrame) -> DataFrame:
    return fact.groupBy("trade_date").agg(rounded(exact_mean(F.col("close_price")), 4).alias("avg_close"))


def top_volume(fact: DataFrame, limit: int = 20) -> DataFrame:
    total = fact.groupBy("ticker").agg(F.sum("volume").alias("total_volume"))
    return total.orderBy(F.desc_nulls_last("total_volume"), "ticker").limit(limit)


def market_cap_distribution(details: DataFrame) -> DataFrame:
    return details.groupBy("market_cap_description").agg(F.count(F.lit(1)).alias("cnt"))


def top_moves(metrics: DataFrame, metric: str, above: bool, limit: int = 50) -> DataFrame:
    """Largest moves above, or below, a baseline by a percent metric."""
    pct = finite(F.col(metric))
    side = metrics.where(pct > 0 if above else pct < 0)
    order = F.desc(metric) if above else F.asc(metric)
    return side.orderBy(order, "ticker").limit(limit).select("ticker", "current_price", pct.alias("pct"))


def top_change(enriched: DataFrame, gainers: bool, limit: int = 10) -> DataFrame:
    order = F.desc("pct_change") if gainers else F.asc("pct_change")
    return enriched.orderBy(order, "ticker").limit(limit)


def gainers_today(current_day: DataFrame) -> DataFrame:
    return current_day.agg(F.count_if(F.col("last_price") > F.col("open_price")).alias("gainers"))


def dollar_volume_total(current_day: DataFrame) -> DataFrame:
    total = F.sum(exact_dollar_volume(F.col("last_price"), F.col("volume")))
    return current_day.agg(total.cast("double").alias("dollar_volume"))
