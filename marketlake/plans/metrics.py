"""Price-change metrics against baselines and against the open."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from marketlake.functions.prices import change_vs_baseline, pct_return, pct_vs_baseline
from marketlake.functions.rounding import rounded
from marketlake.operators.baselines import DEFAULT_WINDOWS, average_name
from marketlake.operators.merge import merge_update


def metric_pairs(windows: tuple[int, ...] = DEFAULT_WINDOWS) -> dict[str, str]:
    """Metric name -> baseline column it compares with."""
    pairs = {"m_price_change_last_day": "close_price_last_day"}
    pairs.update({f"m_price_change_last_{n}_days": average_name(n) for n in windows})
    return pairs


def metric_names(windows: tuple[int, ...] = DEFAULT_WINDOWS) -> list[str]:
    return [name + suffix for name in metric_pairs(windows) for suffix in ("", "_pct")]


def metric_columns(windows: tuple[int, ...] = DEFAULT_WINDOWS) -> dict[str, Column]:
    price = F.col("current_price")
    columns = {}
    for name, baseline in metric_pairs(windows).items():
        columns[name] = change_vs_baseline(price, F.col(baseline))
        columns[f"{name}_pct"] = pct_vs_baseline(price, F.col(baseline))
    return columns


def price_change_metrics(
    prices: DataFrame, baselines: DataFrame, windows: tuple[int, ...] = DEFAULT_WINDOWS
) -> DataFrame:
    """Six metrics for every price whose ticker has baselines."""
    joined = prices.join(baselines, "ticker")
    return joined.select(
        "ticker",
        "current_price",
        "last_updated_ts",
        *(column.alias(name) for name, column in metric_columns(windows).items()),
    )


def refresh_metrics(metrics_table: DataFrame, prices: DataFrame) -> DataFrame:
    """Update-only merge of new prices into the metrics table.

    The table holds the baselines itself, so one join does both the merge and the
    metrics: the price is merged, then the metrics of updated rows follow from the row.
    """
    incoming = prices.select(
        "ticker",
        "current_price",
        F.col("last_updated_ts").alias("last_updated_datetime"),
        F.lit(True).alias("_new"),
    )
    target = metrics_table.withColumn("_new", F.lit(False))
    merged = merge_update(target, incoming, ["ticker"])
    fresh = {
        name: F.when(F.col("_new"), column).otherwise(F.col(name))
        for name, column in metric_columns().items()
    }
    return merged.withColumns(fresh).select(*metrics_table.columns)


def current_day_enriched(current_day: DataFrame) -> DataFrame:
    """Change against the open and dollar volume, for rows that traded."""
    traded = current_day.where((F.col("open_price") > 0) & (F.col("volume") > 0))
    return traded.select(
        "ticker",
        "open_price",
        "last_price",
        "volume",
        rounded(pct_return(F.col("last_price"), F.col("open_price")), 2).alias("pct_change"),
        (F.col("last_price") * F.col("volume")).alias("dollar_volume"),
    )
