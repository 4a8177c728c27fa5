"""The reports over the lake's own tables, historical and of the current day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from marketlake.operators.loads import Lake
from marketlake.plans import daily, marts, metrics, reports

METRICS = "marts.current_day_metrics"

MOVES = {
    "last": "m_price_change_last_day_pct",
    "90d": "m_price_change_last_90_days_pct",
    "365d": "m_price_change_last_365_days_pct",
}


def historical(
    lake: Lake, sectors: Sequence[str] = (), cap_classes: Sequence[str] = ()
) -> dict[str, DataFrame]:
    """The five historical charts. Filters restrict the tickers of every chart."""
    details = reports.filter_details(lake.table(daily.DETAILS), sectors, cap_classes)
    fact = lake.table(daily.FACT)
    chosen = reports.of_tickers(fact, details) if sectors or cap_classes else fact
    edges = reports.first_last_close(fact)
    return {
        "sector_performance": reports.sector_performance(edges, details),
        "stock_ranking": reports.stock_ranking(edges, details),
        "market_trend": reports.market_trend(chosen),
        "top_volume": reports.top_volume(chosen),
        "market_cap_distribution": reports.market_cap_distribution(details),
    }


def live(
    lake: Lake, sectors: Sequence[str] = (), cap_classes: Sequence[str] = ()
) -> dict[str, DataFrame]:
    """The charts of the current day, over the rows of its last date, and the lists of moves."""
    today = marts.on_date(lake.table(daily.CURRENT_DAY))
    moves = lake.table(METRICS)
    if sectors or cap_classes:
        details = reports.filter_details(lake.table(daily.DETAILS), sectors, cap_classes)
        today, moves = reports.of_tickers(today, details), reports.of_tickers(moves, details)
    enriched = metrics.current_day_enriched(today)
    found = {
        "current_day_enriched": enriched,
        "top_gainers": reports.top_change(enriched, gainers=True),
        "top_losers": reports.top_change(enriched, gainers=False),
        "gainers_today": reports.gainers_today(today),
        "dollar_volume_total": reports.dollar_volume_total(today),
    }
    for short, metric in MOVES.items():
        for side in ("above", "below"):
            found[f"top_{side}_{short}"] = reports.top_moves(moves, metric, side == "above")
    return found
