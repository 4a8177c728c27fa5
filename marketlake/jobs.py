"""Jobs of the lake, for spark-submit or ``python -m marketlake.jobs``.

    history   first load of all bars         details   load of the company details
    day       load of one date, marts, checks
    prices    session of the current-day table from landed records
    metrics   session of the metrics table from landed JSON documents
    report    all charts, written as one folder each below --out
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from marketlake.operators.baselines import trailing_baselines
from marketlake.operators import loads
from marketlake.operators.loads import Lake
from marketlake.plans import daily, dashboards, marts
from marketlake.streaming import current_day as live

PRICES, METRICS = "marts.current_day_stock_price", "marts.current_day_metrics"


def _before(lake: Lake, ds: str) -> DataFrame:
    """The fact before a session's date, so that a later run of it starts from the same rows."""
    return lake.table(daily.FACT).where(F.col("trade_date") < F.lit(loads.target_day(ds)))


def _last_closes(lake: Lake, ds: str) -> DataFrame:
    """Last closes before a date: from the dimension, from the fact for tickers that it has
    already taken further."""
    day = F.lit(loads.target_day(ds))
    dim = lake.table(daily.DIM)
    known = dim.where(F.col("last_updated") < day).select(
        "ticker", F.col("latest_price").alias("close_price_last_day")
    )
    later = dim.where(F.col("last_updated") >= day).select("ticker")
    earlier = _before(lake, ds).join(later, "ticker", "left_semi")
    return known.unionByName(
        earlier.groupBy("ticker").agg(F.max_by("close_price", "trade_date").alias("close_price_last_day"))
    )


def write_reports(lake: Lake, out: str, sectors: list[str], cap_classes: list[str]) -> None:
    charts = dashboards.historical(lake, sectors, cap_classes) | dashboards.live(lake, sectors, cap_classes)
    for name, rows in charts.items():
        rows.write.mode("overwrite").parquet(f"{out}/{name}")


def start_prices(
    lake: Lake,
    landing: str,
    ds: str,
    newer_only: bool = False,
    min_rows: int | None = 400,
    interval: str | None = "5 minutes",
    session_hours: bool = False,
) -> StreamingQuery:
    """Seed the session of ``ds`` from the fact before it, unless it has begun, and keep it
    fresh. A restart finds the session's snapshots and checkpoint, and goes on with the next
    batch. ``session_hours`` leaves out records from outside the trading session."""
    table = lake.live(PRICES, ds)
    if not table.versions():
        table.write(live.SEED_VERSION, marts.init_current_day(_before(lake, ds)))
    records = live.price_records(lake.spark, landing)
    if session_hours:
        records = live.session_only(records)
    checkpoint = f"{table.path}/checkpoint"
    return live.start_upserts(records, table, checkpoint, newer_only, min_rows, interval)


def start_metrics(
    lake: Lake, landing: str, ds: str, interval: str | None = "5 minutes"
) -> StreamingQuery:
    """The same for the metrics table, seeded with baselines and market-cap classes."""
    table = lake.live(METRICS, ds)
    if not table.versions():
        baselines = trailing_baselines(_before(lake, ds), closes=_last_closes(lake, ds))
        table.write(live.SEED_VERSION, marts.init_metrics(baselines, lake.table(daily.DETAILS)))
    documents = live.price_documents(lake.spark, landing)
    return live.start_metrics(documents, table, f"{table.path}/checkpoint", interval)


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawTextHelpFormatter)
    parser.add_argument("job", choices=["history", "details", "day", "prices", "metrics", "report"])
    parser.add_argument("--lake", required=True, help="root folder of the lake")
    parser.add_argument("--landing", help="folder of the landed files")
    parser.add_argument("--out", help="folder of the reports")
    parser.add_argument("--sector", action="append", default=[], help="report on this sector only; may repeat")
    parser.add_argument("--cap-class", action="append", default=[], help="report on this market-cap class only")
    parser.add_argument("--session-hours", action="store_true", help="leave out records from outside the session")
    parser.add_argument("--ds", help="run date, yyyy-MM-dd")
    parser.add_argument("--lag-days", type=int, default=0, help="load the date this many days before --ds")
    parser.add_argument("--rejects", help="folder for the lines of a daily file that name no bar")
    parser.add_argument("--strict", action="store_true", help="fail when a quality check fails")
    parser.add_argument("--newer-only", action="store_true", help="older records never replace newer ones")
    parser.add_argument("--min-rows", type=int, default=400, help="fewest rows of the day after a batch")
    parser.add_argument("--interval", help="poll this often, e.g. '5 minutes'; without it, drain once")
    parser.add_argument("--minutes", type=float, help="stop polling after this long")
    args = parser.parse_args(arguments)

    spark = SparkSession.builder.appName(f"marketlake-{args.job}").getOrCreate()
    lake = Lake(spark, args.lake).create()
    if args.job == "history":
        daily.load_history(lake, args.landing)
        daily.rebuild_marts(lake)
    elif args.job == "details":
        daily.load_details(lake, args.landing)
    elif args.job == "day":
        daily.load_day(lake, args.landing, args.ds, args.lag_days, args.rejects)
        daily.update_marts(lake, loads.target_day(args.ds, args.lag_days))
        daily.counts(lake).show(truncate=False)
        daily.check(lake, args.strict, args.landing, args.ds).show(truncate=False)
    elif args.job == "report":
        write_reports(lake, args.out, args.sector, args.cap_class)
    else:
        if args.job == "prices":
            running = start_prices(
                lake, args.landing, args.ds, args.newer_only, args.min_rows, args.interval, args.session_hours
            )
        else:
            running = start_metrics(lake, args.landing, args.ds, args.interval)
        if args.interval and args.minutes:
            live.run_for(running, args.minutes)
        else:
            running.awaitTermination()


if __name__ == "__main__":
    main()
