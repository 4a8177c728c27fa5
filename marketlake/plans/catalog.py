"""Registered queries: key -> (spark, sf_dir) -> DataFrame, each over whole tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from marketlake import schemas
from marketlake.functions.market_cap import market_cap_class
from marketlake.functions.symbols import canonical_symbol
from marketlake.functions.times import in_session, micros_text, wall_clock_to_utc
from marketlake.functions.casting import typed
from marketlake.operators import loads, quality, trading_hours
from marketlake.operators.baselines import rolling_averages, trailing_baselines
from marketlake.operators.buckets import BucketedTable
from marketlake.operators.cleaning import drop_incomplete, one_per_key
from marketlake.operators.history import append_day, cumulative_prices, dim_daily
from marketlake.operators.latest import latest_per_key, ranked_latest, session_bars
from marketlake.operators.loads import Lake
from marketlake.operators.merge import merge_update, merge_upsert
from marketlake.operators.running_totals import RunningTotals, baselines_asof
from marketlake.operators.snapshots import Snapshots
from marketlake.plans import daily, marts, metrics, reports, standins as s
from marketlake.session import fresh_path, fresh_table
from marketlake.sources import csv_files, inline, pages, payloads, quarantine, wide
from marketlake.streaming import current_day as live
from marketlake.streaming.keyed_state import start_keyed_state

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

CURRENT_KEYS = ["ticker", "trade_date"]
LOAD_DAY = dt.date(2024, 1, 15)


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# --- marts ---------------------------------------------------------------------------------


@query
def cumulative_prices_(spark, d):
    return cumulative_prices(s.bars(spark, d))


@query
def dim_daily_(spark, d):
    return dim_daily(s.bars(spark, d))


@query
def dim_daily_incremental(spark, d):
    """The dimension of all dates but the last, and the last date appended."""
    last, bars = s.last_day(spark, d), s.bars(spark, d)
    return append_day(dim_daily(bars.where(F.col("trade_date") < last)), bars.where(F.col("trade_date") == last))


@query
def staging_to_fact(spark, d):
    return loads.staging_to_fact(s.staging(spark, d), LOAD_DAY)


@query
def staging_to_fact_all(spark, d):
    """The same without a date: the first load."""
    return loads.staging_to_fact(s.staging(spark, d))


@query
def staging_dedup(spark, d):
    return one_per_key(s.staging_loaded_twice(spark, d), ["ticker", "snapshot_date"])


@query
def fact_load_day(spark, d):
    """All dates loaded, then one date replaced twice by a run for the day after it."""
    fact = loads.create_table(spark, fresh_table(spark, "fact"), schemas.FACT, ("trade_date",))
    staged = s.staging(spark, d)
    loads.overwrite(loads.staging_to_fact(staged), fact, by=("trade_date",))
    day = loads.target_day(LOAD_DAY + dt.timedelta(days=1), lag_days=1)
    for _ in range(2):
        loads.replace_day(loads.staging_to_fact(staged, day), fact, "trade_date", day)
    return spark.table(fact)


@query
def append_staging(spark, d):
    raw = loads.create_table(spark, fresh_table(spark, "staging"), schemas.STAGING, ("snapshot_date",))
    rows, last = s.staging(spark, d), s.last_day(spark, d)
    loads.append(rows.where(F.col("snapshot_date") < last), raw, by=("snapshot_date",))
    loads.append(rows.where(F.col("snapshot_date") == last), raw, by=("snapshot_date",))
    return spark.table(raw)


@query
def ctas_details(spark, d):
    name = fresh_table(spark, "details")
    loads.create_as(s.tickers(spark, d), name)
    return spark.table(name)


@query
def daily_batch(spark, d):
    """History file, one more daily file loaded twice, both marts: the table served."""
    root = fresh_path(spark, "lake")
    bars = s.staging(spark, d)
    csv_files.write_csv(bars, f"{root}/landing/history")
    csv_files.write_daily(bars, f"{root}/landing")
    lake = Lake(spark, root, prefix=root.rsplit("_", 1)[1].join(("lake_", "_"))).create()
    daily.load_history(lake, f"{root}/landing")
    for _ in range(2):
        daily.load_day(lake, f"{root}/landing", LOAD_DAY.isoformat())
    daily.rebuild_marts(lake)
    daily.check(lake, strict=True)
    return lake.table(daily.DIM)


@query
def dim_daily_caught_up(spark, d):
    """A lake whose later loads all died before the marts: the next run folds every date in."""
    lake = Lake(spark, fresh_path(spark, "lake")).create()
    bars, last = s.bars(spark, d), s.last_day(spark, d)
    for later in (F.col("trade_date") < F.date_sub(last, 9), F.col("trade_date").between(F.date_sub(last, 9), F.date_sub(last, 1)), F.col("trade_date") == last):
        loads.overwrite_partitions(bars.where(later), lake.name(daily.FACT), by=("trade_date",))
        if not daily.folded_dates(lake):
            daily.update_marts(lake)
    daily.update_marts(lake)
    return lake.table(daily.DIM)


# --- sources -------------------------------------------------------------------------------


@query
def csv_daily_roundtrip(spark, d):
    """Every day's file is written; the run's date chooses the one that is read."""
    root = fresh_path(spark, "landing")
    csv_files.write_daily(s.staging(spark, d), root)
    return csv_files.read_bars(spark, root, LOAD_DAY.isoformat())


@query
def csv_quarantine(spark, d):
    """A landed history with spoiled lines: accepted and rejected lines by the ticker they begin with and the reason."""
    root = fresh_path(spark, "landing")
    columns = s.staging(spark, d).columns
    day = F.dayofmonth("snapshot_date")
    texts = {c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns}
    texts["ticker"] = F.when(day != 7, texts["ticker"]).otherwise("")
    texts["snapshot_date"] = F.when(day != 13, texts["snapshot_date"]).otherwise("n/a")
    line = F.concat_ws(",", *texts.values())
    spoiled = F.when(day == 20, F.substring_index(line, ",", 6)).when(day == 21, F.concat(line, F.lit(",more"))).otherwise(line)
    lines = s.staging(spark, d).select(spoiled.alias(",".join(columns)))
    lines.write.option("header", True).option("quote", "").option("sep", "\u0001").csv(csv_files.bars_path(root, None))
    checked = quarantine.checked_bars(spark, root)
    found = checked.select(F.substring_index("line", ",", 1).alias("ticker"), F.coalesce("reason", F.lit("accepted")).alias("reason"))
    return found.groupBy("ticker", "reason").agg(F.count(F.lit(1)).alias("lines"))


@query
def csv_history_roundtrip(spark, d):
    root = fresh_path(spark, "landing")
    csv_files.write_csv(s.staging(spark, d), csv_files.bars_path(root, None))
    return csv_files.read_bars(spark, root)


@query
def csv_details_roundtrip(spark, d):
    path = fresh_path(spark, "details")
    csv_files.write_csv(s.tickers(spark, d), path)
    return csv_files.read_details(spark, path)


@query
def typed_cast(spark, d):
    return typed(s.staging_text(spark, d), schemas.STAGING)


@query
def non_finite_fields(spark, d):
    """NaN and infinities are missing values on every path."""
    return typed(s.staging_non_finite(spark, d), schemas.STAGING)


@query
def normalize_ticker(spark, d):
    return s.class_share_names(spark, d).select(
        "ticker", canonical_symbol(F.col("symbol")).alias("canonical")
    )


@query
def wide_to_long_bars(spark, d):
    """Frames of 500 symbols a line; their places turn back into tickers: 500 x block + place."""
    path = fresh_path(spark, "frames")
    s.land_wide_frames(spark, d, path)
    return _unblocked(wide.melt_bar_lines(wide.read_lines(spark, path), ("block",)))


def _unblocked(rows: DataFrame) -> DataFrame:
    ticker = F.col("block") * s.SYMBOLS_PER_FRAME + F.col("ticker").cast("bigint")
    return rows.withColumn("ticker", ticker.cast("string")).drop("block")


@query
def wide_to_current_day(spark, d):
    """One-minute frames on New York's clock -> the last complete bar of each ticker."""
    path = fresh_path(spark, "frames")
    s.land_intraday_frames(spark, d, path)
    records = _unblocked(wide.melt_intraday_lines(wide.read_lines(spark, path), "America/New_York", ("block",)))
    return latest_per_key(records, ["ticker"], "last_updated_ts")


@query
def drop_incomplete_bars(spark, d):
    return drop_incomplete(s.staging_with_gaps(spark, d))


@query
def union_bars(spark, d):
    """STAGING in seven files, one per weekday, read back as one."""
    path = fresh_path(spark, "parts")
    rows = s.staging(spark, d).withColumn("part", F.weekday("snapshot_date"))
    rows.hint("rebalance", "part").write.partitionBy("part").parquet(path)
    return spark.read.parquet(path).select(*schemas.STAGING.fieldNames())


@query
def json_bars_explode(spark, d):
    return payloads.explode_bars(s.bars_documents(spark, d))


@query
def json_details_flatten(spark, d):
    return payloads.flatten_company(s.company_documents(spark, d))


@query
def values_relation(spark, d):
    """Inline records, upserted into the seeded current-day table."""
    records = inline.current_day_values(
        spark,
        [
            ("3", dt.date(2024, 1, 30), 10.5, 10.0, 11.25, 9.75, 300, dt.datetime(2024, 1, 30, 15, 30)),
            ("BRK.B", dt.date(2024, 1, 30), 401.2, 400.0, 402.0, 399.9, 1200, dt.datetime(2024, 1, 30, 15, 31, 0, 250000)),
            ("BF.B", dt.date(2024, 1, 30), 55.0, None, None, None, 0, None),
        ],
    )
    return merge_upsert(s.base(spark, d), records, CURRENT_KEYS)


@query
def page_list_items(spark, d):
    return pages.list_items(s.table(spark, d, "pages"))


@query
def page_table_symbols(spark, d):
    found = pages.first_table_column(s.constituent_pages(spark, d), "Symbol")
    return found.select("page_id", canonical_symbol(F.col("value")).alias("ticker"))


@query
def session_exchange(spark, d):
    """Events in New York's trading hours, with fixed holidays and a short Christmas Eve, and their minute of the session."""
    events = s.table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    bounds = events.agg(F.date_sub(F.to_date(F.min("ts")), 1).alias("first"), F.to_date(F.max("ts")).alias("last"))
    days = trading_hours.days_between(bounds, F.col("first"), F.col("last"))
    day = F.date_format("trade_date", "MM-dd")
    short = F.when(day == "12-24", F.lit("09:30")), F.when(day == "12-24", F.lit("13:00"))
    other = days.where(day.isin("01-01", "07-04", "12-24", "12-25") & (F.weekday("trade_date") < 5)).select(
        "trade_date", short[0].alias("opens"), short[1].alias("closes")
    )
    hours = trading_hours.trading_hours(days, other)
    kept = trading_hours.within_hours(events, "ts", hours)
    local = F.convert_timezone(F.lit("UTC"), F.lit(trading_hours.ZONE), F.col("ts"))
    minute = (F.hour(local) * 60 + F.minute(local) - 570).alias("session_minute")
    return kept.select("event_id", micros_text(F.col("ts")).alias("ts_text"), minute)


@query
def session_utc(spark, d):
    ts = F.col("ts")
    kept = s.table(spark, d, "events").where(in_session(ts))
    return kept.select(
        "event_id",
        micros_text(ts).alias("ts_text"),
        F.hour(ts).alias("hour"),
        F.weekday(ts).alias("weekday"),
    )


@query
def exchange_time_utc(spark, d):
    utc = wall_clock_to_utc(F.col("ts"), "America/New_York")
    return s.table(spark, d, "events").select("event_id", micros_text(utc).alias("ts_utc"))


# --- current day ---------------------------------------------------------------------------


@query
def latest_bar_per_ticker(spark, d):
    return ranked_latest(s.bars(spark, d), ["ticker"], "trade_date")


@query
def init_current_day(spark, d):
    return s.base(spark, d)


@query
def latest_snapshot(spark, d):
    return latest_per_key(s.feed(spark, d), ["ticker"], "last_updated_ts")


@query
def latest_of_ties(spark, d):
    """Records of one time: the choice is by their values, whatever the partitioning."""
    tied = s.tied_records(spark, d)
    latest = latest_per_key(tied.repartition(7), CURRENT_KEYS, "last_updated_ts")
    other = latest_per_key(tied.repartition(3, "last_price"), CURRENT_KEYS, "last_updated_ts")
    return latest.intersect(other).select(*CURRENT_KEYS, "last_updated_ts")


@query
def session_snapshot(spark, d):
    return session_bars(s.all_records(spark, d)).select(*schemas.CURRENT_DAY.fieldNames())


@query
def merge_update_only(spark, d):
    """Latest prices into the seeds, matched on the ticker alone."""
    prices = latest_per_key(s.feed(spark, d), ["ticker"], "last_updated_ts")
    return merge_update(
        s.base(spark, d), prices.select("ticker", "last_price", "last_updated_ts"), ["ticker"]
    )


def _upserted(spark, d) -> DataFrame:
    """Seeds, then the morning's latest records (inserts), then the whole day's (updates,
    and inserts of tickers that were quiet in the morning)."""
    feed = s.feed(spark, d)
    morning = feed.where(F.hour("last_updated_ts") < 12)
    table = s.base(spark, d)
    for records in (morning, feed):
        latest = latest_per_key(records, CURRENT_KEYS, "last_updated_ts")
        table = merge_upsert(table, latest, CURRENT_KEYS)
    return table


@query
def merge_upsert_(spark, d):
    return _upserted(spark, d)


@query
def merge_upsert_bucketed(spark, d):
    """The same two batches into a bucketed table: each rewrites only the buckets it touches."""
    table = BucketedTable(spark, fresh_path(spark, "buckets"), schemas.CURRENT_DAY)
    table.write(live.SEED_VERSION, s.base(spark, d))
    feed = s.feed(spark, d)
    for version, records in enumerate((feed.where(F.hour("last_updated_ts") < 12), feed)):
        latest = latest_per_key(records, CURRENT_KEYS, "last_updated_ts")
        table.change(version, latest, lambda rows, latest=latest: merge_upsert(rows, latest, CURRENT_KEYS))
    return table.read()


@query
def merge_update_bucketed(spark, d):
    """The update-only merge into a bucketed table."""
    table = BucketedTable(spark, fresh_path(spark, "buckets"), schemas.CURRENT_DAY)
    table.write(live.SEED_VERSION, s.base(spark, d))
    prices = latest_per_key(s.feed(spark, d), ["ticker"], "last_updated_ts").select("ticker", "last_price", "last_updated_ts")
    return table.change(0, prices, lambda rows: merge_update(rows, prices, ["ticker"]))


#: Landing files of one micro-batch; a rate that does not depend on how many have landed.
FILES_PER_BATCH = 10


@query
def stream_current_day(spark, d):
    """FEED as landing files, one per hour, drained in micro-batches. Files of a batch may
    hold any hours, so only newer records replace stored ones."""
    landing, state, checkpoint = (fresh_path(spark, n) for n in ("landing", "state", "checkpoint"))
    s.feed(spark, d).withColumn("hour", F.hour("last_updated_ts")).hint("rebalance", "hour").write.partitionBy(
        "hour"
    ).parquet(landing)
    table = Snapshots(spark, state, schemas.CURRENT_DAY)
    table.write(live.SEED_VERSION, s.base(spark, d))
    records = live.price_records(spark, landing, FILES_PER_BATCH)
    live.start_upserts(records, table, checkpoint, newer_only=True, min_rows=1).awaitTermination()
    return table.read()


@query
def stream_keyed_state(spark, d):
    """The same files through Spark's keyed state: one record per key, newest in event time."""
    landing, state, checkpoint = (fresh_path(spark, n) for n in ("landing", "state", "checkpoint"))
    s.feed(spark, d).withColumn("hour", F.hour("last_updated_ts")).hint("rebalance", "hour").write.partitionBy(
        "hour"
    ).parquet(landing)
    table = BucketedTable(spark, state, schemas.CURRENT_DAY)
    table.write(live.SEED_VERSION, s.base(spark, d))
    start_keyed_state(live.price_records(spark, landing, FILES_PER_BATCH), table, checkpoint).awaitTermination()
    return table.read()


@query
def stream_current_day_metrics(spark, d):
    """LONGFEED as payload documents, merged into the seeded metrics table."""
    landing, state, checkpoint = (fresh_path(spark, n) for n in ("landing", "state", "checkpoint"))
    fact = s.stored_longbars(spark, d)
    s.longfeed_documents(fact).write.text(landing)
    table = Snapshots(spark, state, schemas.METRICS)
    table.write(live.SEED_VERSION, marts.init_metrics(s.longbase(fact), s.tickers(spark, d)))
    live.start_metrics(live.price_documents(spark, landing), table, checkpoint).awaitTermination()
    return table.read()


@query
def current_day_enriched(spark, d):
    return metrics.current_day_enriched(s.current_day(spark, d))


@query
def top_gainers(spark, d):
    return reports.top_change(metrics.current_day_enriched(s.current_day(spark, d)), gainers=True)


@query
def top_losers(spark, d):
    return reports.top_change(metrics.current_day_enriched(s.current_day(spark, d)), gainers=False)


@query
def gainers_today(spark, d):
    return reports.gainers_today(s.current_day(spark, d))


@query
def dollar_volume_total(spark, d):
    return reports.dollar_volume_total(s.current_day(spark, d))


# --- baselines and metrics -------------------------------------------------------------------


@query
def trailing_baselines_(spark, d):
    return trailing_baselines(s.longbars(spark, d), as_of=s.last_ship_day(spark, d))


@query
def trailing_baselines_short(spark, d):
    return trailing_baselines(s.bars(spark, d), (7, 30), as_of=s.last_day(spark, d))


#: Dates in and between the trading dates of LONGBARS.
AS_OF = (dt.date(1993, 12, 31), dt.date(1995, 6, 17), dt.date(1998, 12, 31))


@query
def baselines_asof_(spark, d):
    """90- and 365-day baselines as of three dates, each out of the running totals of three dates."""
    totals = RunningTotals(spark, fresh_path(spark, "totals"))
    fact = s.stored_longbars(spark, d)
    totals.fold(fact.where(F.col("trade_date") < F.lit(AS_OF[1])))
    totals.fold(fact)
    return reduce(
        DataFrame.unionByName, (baselines_asof(totals, day).withColumn("as_of", F.lit(day)) for day in AS_OF)
    )


@query
def rolling_averages_(spark, d):
    return rolling_averages(s.longbars(spark, d))


@query
def init_metrics_table(spark, d):
    name = loads.create_table(spark, fresh_table(spark, "metrics"), schemas.METRICS)
    loads.overwrite(marts.init_metrics(s.longbase(s.stored_longbars(spark, d)), s.tickers(spark, d)), name)
    return spark.table(name)


def _metrics(spark, d) -> DataFrame:
    fact = s.stored_longbars(spark, d)
    return metrics.price_change_metrics(s.longfeed(fact).drop("trade_date"), s.longbase(fact))


@query
def price_change_metrics(spark, d):
    return _metrics(spark, d)


def _register_top_moves() -> None:
    for short, metric in {
        "last": "m_price_change_last_day_pct",
        "90d": "m_price_change_last_90_days_pct",
        "365d": "m_price_change_last_365_days_pct",
    }.items():
        for side in ("above", "below"):

            def top(spark, d, metric=metric, above=side == "above"):
                return reports.top_moves(_metrics(spark, d), metric, above)

            QUERIES[f"top_{side}_{short}"] = top


_register_top_moves()


@query
def filtered_moves(spark, d):
    """The list above the last close, of some sectors and market-cap classes only."""
    listed = reports.filter_details(
        s.tickers(spark, d), sectors=("BUILDING", "MACHINERY"), cap_classes=("Mega Cap", "Large Cap")
    )
    moves = reports.of_tickers(_metrics(spark, d), listed)
    return reports.top_moves(moves, "m_price_change_last_day_pct", above=True)


# --- reports -------------------------------------------------------------------------------


def _edges(spark, d) -> DataFrame:
    first, last = s.first_day(spark, d), s.last_day(spark, d)
    return reports.first_last_close(s.bars(spark, d, days=(first, last)), first, last)


@query
def first_last_close(spark, d):
    return _edges(spark, d)


@query
def sector_performance(spark, d):
    return reports.sector_performance(_edges(spark, d), s.tickers(spark, d))


@query
def stock_ranking(spark, d):
    return reports.stock_ranking(_edges(spark, d), s.tickers(spark, d))


@query
def filtered_ranking(spark, d):
    return reports.stock_ranking(
        _edges(spark, d),
        s.tickers(spark, d),
        sectors=("BUILDING", "MACHINERY"),
        cap_classes=("Mega Cap", "Large Cap"),
    )


@query
def market_trend(spark, d):
    return reports.market_trend(s.bars(spark, d))


@query
def top_volume(spark, d):
    return reports.top_volume(s.bars(spark, d))


FILTERS = {"sectors": ("BUILDING", "MACHINERY"), "cap_classes": ("Mega Cap", "Large Cap")}


@query
def filtered_trend(spark, d):
    return reports.market_trend(reports.of_tickers(s.bars(spark, d), reports.filter_details(s.tickers(spark, d), **FILTERS)))


@query
def filtered_volume(spark, d):
    return reports.top_volume(reports.of_tickers(s.bars(spark, d), reports.filter_details(s.tickers(spark, d), **FILTERS)))


@query
def filtered_distribution(spark, d):
    return reports.market_cap_distribution(reports.filter_details(s.tickers(spark, d), **FILTERS))


@query
def market_cap_class_(spark, d):
    return s.tickers(spark, d).select(
        "ticker", "market_cap", market_cap_class(F.col("market_cap")).alias("market_cap_description")
    )


@query
def market_cap_distribution(spark, d):
    return reports.market_cap_distribution(s.tickers(spark, d))


# --- data quality -----------------------------------------------------------------------------


@query
def dq_null_checks(spark, d):
    return quality.null_checks(
        s.bars(spark, d), {"ticker_ok": "ticker", "close_ok": "close_price", "date_ok": "trade_date"}
    )


@query
def dq_row_counts(spark, d):
    fact = s.bars(spark, d)
    return quality.row_counts(
        {
            "raw.staging": s.staging(spark, d),
            "stg.fact": fact,
            "marts.cumulative": cumulative_prices(fact),
            "marts.dim_daily": dim_daily(fact),
            "marts.dim_ticker": s.tickers(spark, d),
            "marts.current_day": s.base(spark, d),
        }
    )


@query
def dq_dim_matches_fact(spark, d):
    fact = s.bars(spark, d)
    return quality.dim_matches_fact(dim_daily(fact), fact)


@query
def dq_report(spark, d):
    fact = s.bars(spark, d)
    return quality.quality_report(fact, dim_daily(fact))


@query
def dq_report_spoiled(spark, d):
    """The same checks where they must fail: closes are missing on one day of the month, and
    the dimension lacks the tickers that had no bar on the last date."""
    fact = loads.staging_to_fact(s.staging_with_gaps(spark, d))
    dim = dim_daily(fact).where(F.col("last_updated") == s.last_day(spark, d))
    return quality.quality_report(fact, dim)


@query
def dq_dim_lacks_tickers(spark, d):
    fact = s.bars(spark, d)
    return quality.dim_matches_fact(dim_daily(fact).where(F.col("last_updated") == s.last_day(spark, d)), fact)


@query
def current_day_sanity(spark, d):
    return quality.current_day_sanity(_upserted(spark, d), s.last_day(spark, d), min_rows=100)


@query
def load_profile(spark, d):
    return quality.load_profile(s.staging(spark, d))


# Functions that share their name with the operator they call end in an underscore.
QUERIES.update({name.rstrip("_"): QUERIES.pop(name) for name in list(QUERIES)})
