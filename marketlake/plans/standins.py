"""Market inputs derived from the test tables (see FIXTURES.md), always over whole tables."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from marketlake import schemas
from marketlake.functions.market_cap import market_cap_class
from marketlake.functions.symbols import feed_symbol
from marketlake.functions.times import micros_text
from marketlake.operators.baselines import trailing_baselines
from marketlake.plans.marts import as_current_day, init_current_day
from marketlake.session import fresh_path

SYMBOLS_PER_DOCUMENT = 500
SYMBOLS_PER_FRAME = 500


_SCHEMAS: dict[str, T.StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table. Its schema is read from a file footer once, not by every query."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def _id(column: str) -> Column:
    return F.col(column).cast("string")


# --- daily bars out of events ------------------------------------------------------------


def first_day(spark: SparkSession, sf_dir: str) -> Column:
    """First date of BARS, read from one column of the events instead of from the bars."""
    return table(spark, sf_dir, "events").agg(F.to_date(F.min("ts"))).scalar()


def last_day(spark: SparkSession, sf_dir: str) -> Column:
    return table(spark, sf_dir, "events").agg(F.to_date(F.max("ts"))).scalar()


def _bars_of(events: DataFrame) -> DataFrame:
    """Partial aggregates shrink a hot ticker to one row per date and task before the shuffle."""
    daily = events.groupBy("user_id", F.to_date("ts").alias("trade_date")).agg(
        F.min_by("value", "ts").alias("open_price"),
        F.max("value").alias("high_price"),
        F.min("value").alias("low_price"),
        F.max_by("value", "ts").alias("close_price"),
        F.count(F.lit(1)).alias("volume"),
    )
    return daily.withColumn("ticker", _id("user_id")).select(*schemas.FACT.fieldNames())


def bars(spark: SparkSession, sf_dir: str, days: tuple[Column, ...] = ()) -> DataFrame:
    """All bars, or those of some days. Days become ranges on ``ts``, which skip row groups
    in the scan; a comparison of the derived date could not."""
    events = table(spark, sf_dir, "events")
    if days:
        events = events.where(reduce(or_, (_within(F.col("ts"), day) for day in days)))
    return _bars_of(events)


def _within(ts: Column, day: Column) -> Column:
    return (ts >= day.cast("timestamp_ntz")) & (ts < F.date_add(day, 1).cast("timestamp_ntz"))


def staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bars(spark, sf_dir).select(
        "ticker",
        F.col("trade_date").alias("snapshot_date"),
        *(F.col(f"{p}_price").alias(p) for p in ("open", "high", "low", "close")),
        "volume",
    )


def staging_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STAGING as text with some fields spoiled by rule."""
    rows = staging(spark, sf_dir)
    day = F.dayofmonth("snapshot_date")
    spoiled = {
        "snapshot_date": F.when(day == 13, F.date_format("snapshot_date", "dd/MM/yyyy")),
        "open": F.when(day == 20, F.lit("12,5")),
        "close": F.when(day == 7, F.lit("")),
        "volume": F.when(F.col("volume") == 2, F.lit("2.0")).when(F.col("volume") == 4, F.lit("n/a")),
    }
    return rows.select(
        *(F.coalesce(spoiled.get(c, F.lit(None)), F.col(c).cast("string")).alias(c) for c in rows.columns)
    )


def staging_non_finite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STAGING as text in which some prices are no finite numbers."""
    day = F.dayofmonth("snapshot_date")
    spoiled = {
        "open": F.when(day == 5, F.lit("NaN")).when(day == 6, F.lit("Infinity")),
        "high": F.when(day == 6, F.lit("inf")),
        "close": F.when(day == 8, F.lit("-Infinity")).when(day == 11, F.lit("nan")),
        "volume": F.when(day == 12, F.lit("NaN")),
    }
    rows = staging(spark, sf_dir)
    return rows.select(
        *(F.coalesce(spoiled.get(c, F.lit(None)), F.col(c).cast("string")).alias(c) for c in rows.columns)
    )


def staging_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STAGING in which the close is NULL on one day of the month and the open NaN on another."""
    day = F.dayofmonth("snapshot_date")
    return (
        staging(spark, sf_dir)
        .withColumn("close", F.when(day != 9, F.col("close")))
        .withColumn("open", F.when(day == 10, F.lit(float("nan"))).otherwise(F.col("open")))
    )


def staging_loaded_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STAGING after a retried load: every row is there twice."""
    rows = staging(spark, sf_dir)
    return rows.withColumn("attempt", F.explode(F.array(F.lit(1), F.lit(2)))).drop("attempt")


#: Fields of a wide frame and the columns of bars that they come from.
_FRAME_FIELDS = {"Open": "open_price", "High": "high_price", "Low": "low_price", "Close": "close_price", "Volume": "volume"}


def land_wide_frames(spark: SparkSession, sf_dir: str, path: str) -> None:
    """BARS as landed wide frames: block b holds tickers 500b .. 500b + 499, one line per date with a
    ``<place>_<Field>`` column for each place, so any number of tickers fits. A volume is NaN and
    prices are empty where a ticker has no bar, as such frames come."""
    _land_blocked(bars(spark, sf_dir).withColumnRenamed("trade_date", "Date"), "Date", path)


def _land_blocked(rows: DataFrame, time: str, path: str) -> None:
    """Bars -> lines of wide frames with one shuffle: a block's bars of one time, at most 500, become a
    map by place, and the line looks every place up. Each block's folder gets its header as well."""
    number = F.col("ticker").cast("bigint")
    values = [F.col(c).cast("string") for c in _FRAME_FIELDS.values()]
    placed = rows.select(
        F.floor(number / SYMBOLS_PER_FRAME).alias("block"),
        time,
        F.pmod(number, F.lit(SYMBOLS_PER_FRAME)).cast("int").alias("place"),
        F.array_join(F.array(*values), ",", "").alias("cells"),
    )
    places = F.sequence(F.lit(0), F.lit(SYMBOLS_PER_FRAME - 1))
    listed = placed.groupBy("block", time).agg(F.map_from_entries(F.array_agg(F.struct("place", "cells"))).alias("by_place"))
    cells = F.transform(places, lambda i: F.coalesce(F.try_element_at("by_place", i), F.lit(",,,,NaN")))
    lines = listed.select("block", F.concat_ws(",", F.col(time).cast("string"), F.array_join(cells, ",")).alias("value"))
    names = F.array_join(F.transform(places, lambda i: F.array_join(F.transform(
        F.array(*map(F.lit, _FRAME_FIELDS)), lambda field: F.concat(i.cast("string"), F.lit("_"), field)), ",")), ",")
    blocks = rows.select(F.floor(number / SYMBOLS_PER_FRAME).alias("block")).distinct()
    headers = blocks.select("block", F.concat_ws(",", F.lit(time), names).alias("value"))
    lines.unionByName(headers).hint("rebalance", "block").write.partitionBy("block").text(path)


# --- company details out of customers ----------------------------------------------------


def tickers(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    cap = F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal") * 25000000)
    located = customer.join(nation, customer.c_nationkey == nation.n_nationkey, "left").join(
        region, nation.n_regionkey == region.r_regionkey, "left"
    )
    return located.select(
        _id("c_custkey").alias("ticker"),
        F.col("c_name").alias("company_name"),
        F.col("c_mktsegment").alias("sector"),
        F.col("c_mktsegment").alias("industry"),
        cap.alias("market_cap"),
        market_cap_class(cap).alias("market_cap_description"),
        F.col("r_name").alias("exchange"),
        F.col("n_name").alias("country"),
    )


def company_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TICKERS as company-information documents; one sector's documents lack the field."""
    d = tickers(spark, sf_dir)
    sector = F.when(F.col("sector") != "HOUSEHOLD", F.col("sector"))
    info = F.struct(
        F.col("ticker").alias("symbol"), F.col("company_name").alias("shortName"), sector.alias("sector"),
        "industry", F.col("market_cap").alias("marketCap"), "exchange", "country",
    )
    return d.select(F.to_json(info).alias("payload"))


def class_share_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tickers with a symbol in feed spelling, made from the company name."""
    d = tickers(spark, sf_dir)
    return d.select("ticker", F.translate("company_name", "#", "-").alias("symbol"))


def constituent_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TICKERS as HTML pages with a table of at most 500 constituents each, followed by a
    second table that is not to be read."""
    d = tickers(spark, sf_dir)
    page = F.floor(F.col("ticker").cast("bigint") / SYMBOLS_PER_DOCUMENT)
    row = F.concat(
        F.lit("<tr>\n<td>"), "company_name", F.lit('</td><td><a href="/q">'), "ticker", F.lit("</a>\n</td></tr>")
    )
    head = '<html><table class="wikitable"><tr><th>Security</th><th>Symbol</th></tr>'
    foot = "</table><table><tr><th>Symbol</th></tr><tr><td>none</td></tr></table></html>"
    return d.groupBy(page.alias("page_id")).agg(
        F.concat(F.lit(head), F.array_join(F.collect_list(row), ""), F.lit(foot)).alias("html")
    )


# --- seven years of bars out of lineitem --------------------------------------------------


def longbars(spark: SparkSession, sf_dir: str) -> DataFrame:
    cents = F.floor(F.col("l_extendedprice") * 100 + 0.5)
    unit = F.try_divide("l_extendedprice", "l_quantity")
    daily = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_suppkey", F.to_date("l_shipdate").alias("trade_date"))
        .agg(
            F.sum(cents).alias("cents"),
            F.sum(F.col("l_quantity").cast("decimal(18,2)")).alias("pieces"),
            F.max(unit).alias("high_price"),
            F.min(unit).alias("low_price"),
        )
    )
    return (
        daily.withColumn("ticker", _id("l_suppkey"))
        .withColumn("open_price", F.col("low_price"))
        .withColumn("close_price", F.try_divide(F.col("cents").cast("double") / 100, F.col("pieces").cast("double")))
        .withColumn("volume", F.col("pieces").cast("bigint"))
        .select(*schemas.FACT.fieldNames())
    )


def last_ship_day(spark: SparkSession, sf_dir: str) -> Column:
    return table(spark, sf_dir, "lineitem").agg(F.to_date(F.max("l_shipdate"))).scalar()


def stored_longbars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """LONGBARS written to the shared folder, as the fact of a lake is: within a query feed,
    baselines and as-of date each read a few of its columns, instead of aggregating all line
    items three times. Every query writes, and pays for, its own."""
    path = fresh_path(spark, "longbars")
    longbars(spark, sf_dir).write.parquet(path)
    return spark.read.schema(schemas.FACT).parquet(path)


def longfeed(fact: DataFrame) -> DataFrame:
    """Latest record per ticker of LONGBARS, as an incoming price."""
    latest = fact.groupBy("ticker").agg(
        F.max("trade_date").alias("trade_date"),
        F.max_by("close_price", "trade_date").alias("current_price"),
    )
    return latest.withColumn("last_updated_ts", F.col("trade_date").cast("timestamp_ntz"))


def longbase(fact: DataFrame) -> DataFrame:
    """90- and 365-day baselines over LONGBARS without the LONGFEED records."""
    feed = longfeed(fact).select("ticker", F.col("trade_date").alias("feed_date"))
    history = fact.select("ticker", "trade_date", "close_price")
    earlier = history.join(feed, "ticker").where(F.col("trade_date") < F.col("feed_date"))
    return trailing_baselines(earlier)


def longfeed_documents(fact: DataFrame) -> DataFrame:
    """LONGFEED as payload documents of at most 500 symbols."""
    prices = longfeed(fact).withColumn("block", F.floor(F.col("ticker").cast("bigint") / SYMBOLS_PER_DOCUMENT))
    return pack_bars(prices, ["block"], "current_price")


# --- current day ---------------------------------------------------------------------------


def base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current-day table before the session: latest bars before the last date."""
    last = last_day(spark, sf_dir)
    return init_current_day(bars(spark, sf_dir).where(F.col("trade_date") < last))


def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price records of the last date. The range on ``ts`` reaches the parquet scan."""
    last = last_day(spark, sf_dir)
    return _records(table(spark, sf_dir, "events").where(_within(F.col("ts"), last)))


def all_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events of all dates as price records."""
    return _records(table(spark, sf_dir, "events"))


def tied_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FEED in which all records of an hour have one time, as a feed of whole hours has."""
    ts = F.col("last_updated_ts")
    return feed(spark, sf_dir).withColumn("last_updated_ts", F.date_trunc("hour", ts).cast("timestamp_ntz"))


def _records(events: DataFrame) -> DataFrame:
    price = F.col("value")
    return events.select(
        _id("user_id").alias("ticker"),
        F.to_date("ts").alias("trade_date"),
        *(price.alias(f"{p}_price") for p in ("last", "open", "high", "low")),
        F.lit(1).cast("bigint").alias("volume"),
        F.col("ts").alias("last_updated_ts"),
    ).select(*schemas.CURRENT_DAY.fieldNames())


def current_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """BARS of the last date as current-day rows."""
    return as_current_day(bars(spark, sf_dir, days=(last_day(spark, sf_dir),)))


def land_intraday_frames(spark: SparkSession, sf_dir: str, path: str) -> None:
    """FEED as landed one-minute frames, blocked like ``land_wide_frames``."""
    ts = F.col("last_updated_ts")
    minute = ts - F.make_dt_interval(secs=F.extract(F.lit("SECOND"), ts))
    bars = feed(spark, sf_dir).groupBy("ticker", minute.alias("Datetime")).agg(
        F.min_by("last_price", "last_updated_ts").alias("open_price"),
        F.max("last_price").alias("high_price"),
        F.min("last_price").alias("low_price"),
        F.max_by("last_price", "last_updated_ts").alias("close_price"),
        F.count(F.lit(1)).alias("volume"),
    )
    _land_blocked(bars, "Datetime", path)


def pack_bars(prices: DataFrame, document_keys: list[str], price: str) -> DataFrame:
    """Price rows -> payload documents, one per key combination. Callers choose keys that
    bound a document's size; symbols take the feed's spelling, times all six digits."""
    bar = F.struct(
        F.col(price).alias("c"),
        F.concat(F.translate(micros_text(F.col("last_updated_ts")), " ", "T"), F.lit("Z")).alias("t"),
    )
    entry = F.struct(feed_symbol(F.col("ticker")).alias("symbol"), bar.alias("bar"))
    body = F.struct(F.map_from_entries(F.collect_list(entry)).alias("bars"))
    return prices.groupBy(*document_keys).agg(F.to_json(body).alias("payload")).select("payload")


def hourly_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All records reduced to the latest per ticker, date and hour."""
    hourly = all_records(spark, sf_dir).withColumn("hour", F.hour("last_updated_ts"))
    return hourly.groupBy("ticker", "trade_date", "hour").agg(
        F.max_by("last_price", "last_updated_ts").alias("last_price"),
        F.max("last_updated_ts").alias("last_updated_ts"),
    )


def bars_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly records as payload documents: one per date, hour and block of 500 symbols."""
    rows = hourly_records(spark, sf_dir).withColumn(
        "block", F.floor(F.col("ticker").cast("bigint") / SYMBOLS_PER_DOCUMENT)
    )
    return pack_bars(rows, ["trade_date", "hour", "block"], "last_price")
