"""The daily batch: landed CSV -> raw -> fact -> marts -> checks."""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import DataFrame, functions as F

from marketlake.operators import loads
from marketlake.operators.cleaning import one_per_key
from marketlake.operators.history import append_days, dim_daily
from marketlake.operators.loads import Lake
from marketlake.operators.quality import quality_report, require, row_counts
from marketlake.sources import quarantine
from marketlake.sources.csv_files import read_bars, read_details

RAW = "raw.staging_daily_stock_price"
FACT = "stg.fact_daily_stock_price"
CUMULATIVE = "marts.cumulative_stock_price"
DIM = "marts.dim_daily_stock_price"
DETAILS = "marts.dim_ticker_details"
CURRENT_DAY = "marts.current_day_stock_price"

BAR_KEY = ["ticker", "snapshot_date"]


def _dated(rows: DataFrame) -> DataFrame:
    """Rows that name a bar. The others are counted by ``rejected_rows``."""
    return rows.where(F.col("ticker").isNotNull() & F.col("snapshot_date").isNotNull())


def load_history(lake: Lake, landing: str) -> int:
    """First load: the full history replaces raw, and its dates those of the fact; later
    dates that the fact has from daily files stay. Returns the raw row count."""
    rows = loads.overwrite(_dated(read_bars(lake.spark, landing)), lake.name(RAW), by=("snapshot_date",))
    unique = one_per_key(lake.table(RAW), BAR_KEY)
    loads.overwrite_partitions(loads.staging_to_fact(unique), lake.name(FACT), by=("trade_date",))
    return rows


def load_day(lake: Lake, landing: str, ds: str, lag_days: int = 0, rejects: str | None = None) -> int:
    """Replace the dates of the file of ``ds`` in raw, then the target date of the fact.

    A retry or a corrected file takes the place of what an earlier one brought. Rows that a
    file repeats are reduced to one per bar on the way to the fact. With a folder of ``rejects``
    lines that name no bar, or have too few or too many fields, go there with their reason.
    """
    if rejects is None:
        bars = _dated(read_bars(lake.spark, landing, ds))
    else:
        checked = quarantine.checked_bars(lake.spark, landing, ds)
        quarantine.rejected(checked).write.mode("overwrite").parquet(f"{rejects}/ds={ds}")
        bars = quarantine.accepted(checked)
    rows = loads.overwrite_partitions(bars, lake.name(RAW), by=("snapshot_date",))
    day = loads.target_day(ds, lag_days)
    unique = one_per_key(lake.table(RAW).where(F.col("snapshot_date") == F.lit(day)), BAR_KEY)
    loads.replace_day(loads.staging_to_fact(unique), lake.name(FACT), "trade_date", day)
    return rows


def load_details(lake: Lake, path: str) -> int:
    return loads.overwrite(read_details(lake.spark, path), lake.name(DETAILS))


def rebuild_marts(lake: Lake) -> None:
    """Both per-ticker marts. The history is aggregated from the fact once; the cumulative
    table is a projection of the daily dimension, a view that needs no rows of its own."""
    _publish_marts(lake, dim_daily(lake.table(FACT)), fact_dates(lake))


def fact_dates(lake: Lake) -> dict[str, int]:
    """Bars of every date of the fact. No column is read but the partition's, and one number
    for each trading date comes back."""
    dates = lake.table(FACT).where("trade_date IS NOT NULL").groupBy("trade_date").agg(F.count(F.lit(1)).alias("bars"))
    return {r["trade_date"].isoformat(): r["bars"] for r in dates.collect()}


def folded_dates(lake: Lake) -> dict[str, int]:
    """The ledger of the marts: the dates that they were made of, and each one's bars then.
    It is published with the rows, so a run that dies leaves both or neither."""
    return json.loads(lake.mart(DIM).note() or "{}")


def update_marts(lake: Lake, day: dt.date | None = None) -> list[str]:
    """Bring both marts up to the fact and return the dates that were folded in.

    Whatever earlier runs have loaded and not folded in is in the fact and not in the ledger.
    Dates later than all folded ones are appended, together; a date that was folded in and has
    changed since (by its number of bars, or as ``day``, the date just loaded again), that has
    gone, or that belongs between others makes the marts anew.
    """
    known, there = folded_dates(lake), fact_dates(lake)
    changed = {date for date, bars in known.items() if there.get(date) != bars}
    if day is not None and day.isoformat() in known:
        changed.add(day.isoformat())
    missing = sorted(set(there) - set(known))
    if not known or changed or (missing and missing[0] < max(known)):
        _publish_marts(lake, dim_daily(lake.table(FACT)), there)
        return sorted(changed | set(missing))
    if missing:
        bars = lake.table(FACT).where(F.col("trade_date") > F.lit(dt.date.fromisoformat(max(known))))
        _publish_marts(lake, append_days(lake.mart(DIM).read(), bars), there)
    return missing


def _publish_marts(lake: Lake, dim: DataFrame, dates: dict[str, int]) -> None:
    mart = lake.mart(DIM)
    mart.write(max(mart.versions(), default=-1) + 1, dim, note=json.dumps(dates, sort_keys=True))


def rejected_rows(lake: Lake, landing: str, ds: str | None = None) -> DataFrame:
    """A check row: how many rows of a file name no bar, for a missing or unreadable date or
    ticker, and were not loaded."""
    bars = read_bars(lake.spark, landing, ds)
    lost = F.count_if(F.col("ticker").isNull() | F.col("snapshot_date").isNull())
    return bars.agg(lost.alias("observed")).select(
        F.lit("rejected rows").alias("check_name"),
        (F.col("observed") == 0).alias("passed"),
        "observed",
        F.lit(0).cast("bigint").alias("expected"),
    )


def counts(lake: Lake) -> DataFrame:
    """Rows of the six tables."""
    return row_counts({name: lake.table(name) for name in (RAW, FACT, CUMULATIVE, DIM, DETAILS, CURRENT_DAY)})


def check(
    lake: Lake, strict: bool = False, landing: str | None = None, ds: str | None = None
) -> DataFrame:
    """All batch checks; with a landing folder also that of the rejected rows of its file."""
    report = quality_report(lake.table(FACT), lake.table(DIM))
    if landing is not None:
        report = report.unionByName(rejected_rows(lake, landing, ds))
    return require(report) if strict else report
