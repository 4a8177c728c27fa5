"""One ticker, and one repeated bar, with more than a third of all rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from marketlake.operators.cleaning import one_per_key
from marketlake.operators.history import dim_daily
from marketlake.operators.latest import latest_per_key
from marketlake.plans import reports, standins

ROWS = 300_000


@pytest.fixture(scope="module")
def events(spark):
    """User 0 has 40 % of the events; every event time is distinct."""
    n = F.col("id")
    hot = n % 5 < 2
    return spark.range(ROWS, numPartitions=12).select(
        n.alias("event_id"),
        F.timestamp_seconds(F.lit(1704067200) + n * 8).cast("timestamp_ntz").alias("ts"),
        F.when(hot, 0).otherwise(n % 1000 + 1).cast("bigint").alias("user_id"),
        ((n * 7919) % 10007 / 100).alias("value"),
    )




def test_bars_of_a_hot_ticker(spark, events):
    bars = standins._bars_of(events)
    assert bars.where("ticker = '0'").agg(F.sum("volume")).first()[0] == ROWS * 2 // 5
    assert bars.count() == bars.select("ticker", "trade_date").distinct().count()
    row = dim_daily(bars).where("ticker = '0'").first()
    days = ROWS * 8 // 86400 + 1
    assert len(row.price_history) == days and row.last_updated == dt.date(2024, 1, 1) + dt.timedelta(days=days - 1)
    hot = events.where("user_id = 0")
    assert row.latest_price == hot.orderBy(F.desc("ts")).first().value


def test_latest_of_a_hot_ticker(spark, events):
    latest = latest_per_key(events, ["user_id"], "ts")
    assert latest.count() == events.select("user_id").distinct().count()
    assert latest.where("user_id = 0").first().ts == events.where("user_id = 0").agg(F.max("ts")).first()[0]


def test_copies_of_one_bar_collapse(spark, events):
    copies = events.select(
        F.when(F.col("user_id") == 0, "HOT").otherwise(F.col("user_id").cast("string")).alias("ticker"),
        F.lit(dt.date(2024, 1, 1)).alias("snapshot_date"),
        F.when(F.col("user_id") == 0, 1.0).otherwise(F.col("value")).alias("close"),
    )
    kept = one_per_key(copies, ["ticker", "snapshot_date"])
    assert kept.count() == copies.select("ticker").distinct().count()
    assert kept.where("ticker = 'HOT'").count() == 1


def test_trend_over_a_hot_ticker_is_whole(spark, events):
    bars = standins._bars_of(events)
    got = {r.trade_date: r.avg_close for r in reports.market_trend(bars).collect()}
    plain = {r.trade_date: r.m for r in bars.groupBy("trade_date").agg(F.avg("close_price").alias("m")).collect()}
    assert set(got) == set(plain)
    assert all(abs(got[d] - plain[d]) < 1e-4 for d in got)
