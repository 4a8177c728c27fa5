"""Micro-batch upkeep: equal to the batch result, replayable, last writer wins."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from marketlake import schemas
from marketlake.operators.latest import latest_per_key
from marketlake.operators.merge import merge_upsert
from marketlake.operators.snapshots import Snapshots
from marketlake.plans import marts, standins
from marketlake.session import fresh_path
from marketlake.sources import inline
from marketlake.streaming import current_day as live

DAY = dt.date(2024, 1, 5)
KEYS = ["ticker", "trade_date"]


def record(ticker, price, hour, day=DAY):
    at = dt.datetime(day.year, day.month, day.day, hour)
    return (ticker, day, price, price, price, price, 1, at)


@pytest.fixture()
def live_table(spark):
    """An empty seeded table, its landing folder and its checkpoint."""
    table = Snapshots(spark, fresh_path(spark, "state"), schemas.CURRENT_DAY)
    table.write(live.SEED_VERSION, inline.current_day_values(spark, [record("A", 1.0, 1, DAY - dt.timedelta(days=1))]))
    return table, fresh_path(spark, "landing"), fresh_path(spark, "checkpoint")


def land(spark, path, rows):
    inline.current_day_values(spark, rows).coalesce(1).write.mode("append").parquet(path)


def drain(spark, live_table, **options):
    table, landing, checkpoint = live_table
    live.start_upserts(live.price_records(spark, landing, 1), table, checkpoint, **options).awaitTermination()
    return {(r.ticker, r.trade_date, r.last_price) for r in table.read().collect()}


def test_later_batches_overwrite_even_with_older_records(spark, live_table):
    land(spark, live_table[1], [record("A", 2.0, 15), record("A", 3.0, 16), record("B", 5.0, 15)])
    assert drain(spark, live_table) == {("A", DAY - dt.timedelta(days=1), 1.0), ("A", DAY, 3.0), ("B", DAY, 5.0)}
    land(spark, live_table[1], [record("A", 9.0, 14)])
    assert ("A", DAY, 9.0) in drain(spark, live_table)


def test_newer_only_ignores_older_records(spark, live_table):
    land(spark, live_table[1], [record("A", 3.0, 16)])
    drain(spark, live_table, newer_only=True)
    land(spark, live_table[1], [record("A", 9.0, 14), record("C", 1.0, 14)])
    got = drain(spark, live_table, newer_only=True)
    assert ("A", DAY, 3.0) in got and ("C", DAY, 1.0) in got


def test_a_replayed_batch_gives_the_same_table(spark, live_table):
    table, landing, checkpoint = live_table
    land(spark, landing, [record("A", 2.0, 15)])
    drain(spark, live_table)
    land(spark, landing, [record("A", 4.0, 16)])
    first = drain(spark, live_table)
    # The same two files again without the checkpoint: batch ids start over.
    again = (table, landing, fresh_path(spark, "checkpoint"))
    assert drain(spark, again) == first


def test_too_few_rows_stop_the_stream(spark, live_table):
    land(spark, live_table[1], [record("A", 2.0, 15)])
    with pytest.raises(Exception, match="data-quality"):
        drain(spark, live_table, min_rows=2)


def test_empty_batches_are_skipped(spark, live_table):
    table, landing, checkpoint = live_table
    land(spark, landing, [record("A", 2.0, 3)])
    records = live.session_only(live.price_records(spark, landing))
    live.start_upserts(records, table, checkpoint).awaitTermination()
    assert table.versions() == [live.SEED_VERSION]


def test_polling_runs_until_its_time_is_over(spark, live_table):
    table, landing, checkpoint = live_table
    land(spark, landing, [record("A", 2.0, 15)])
    query = live.start_upserts(live.price_records(spark, landing), table, checkpoint, interval="1 second")
    live.run_for(query, minutes=0.2)
    assert not query.isActive and table.versions() == [live.SEED_VERSION, 0]


def test_stream_equals_batch(spark, smallest_dir):
    d = smallest_dir
    table = Snapshots(spark, fresh_path(spark, "state"), schemas.CURRENT_DAY)
    table.write(live.SEED_VERSION, standins.base(spark, d))
    landing = fresh_path(spark, "landing")
    standins.feed(spark, d).withColumn("hour", F.hour("last_updated_ts")).write.partitionBy("hour").parquet(landing)
    records = live.price_records(spark, landing, 5)
    live.start_upserts(records, table, fresh_path(spark, "checkpoint"), newer_only=True).awaitTermination()
    latest = latest_per_key(standins.feed(spark, d), KEYS, "last_updated_ts")
    batch = merge_upsert(standins.base(spark, d), latest, KEYS)
    assert sorted(map(tuple, table.read().collect())) == sorted(map(tuple, batch.collect()))


def test_metrics_stream_updates_known_tickers(spark):
    table = Snapshots(spark, fresh_path(spark, "state"), schemas.METRICS)
    baselines = spark.createDataFrame(
        [("BRK.B", 10.0, 8.0, 0.0), ("B", 10.0, 8.0, 5.0)],
        "ticker string, close_price_last_day double, close_price_avg_last_90_days double, close_price_avg_last_365_days double",
    )
    details = spark.createDataFrame([], schemas.DETAILS)
    table.write(live.SEED_VERSION, marts.init_metrics(baselines, details))
    landing = fresh_path(spark, "landing")
    docs = [
        '{"bars": {"BRK-B": {"c": 11, "t": "2024-01-05T15:30:00Z"}, "Z": {"c": 1.5, "t": "2024-01-05T15:30:00Z"}}}',
        '{"bars": {"BRK-B": {"c": 12, "t": "2024-01-05T15:31:00Z"}}}', "{}",
    ]
    spark.createDataFrame([(d,) for d in docs], "value string").write.text(landing)
    live.start_metrics(live.price_documents(spark, landing), table, fresh_path(spark, "checkpoint")).awaitTermination()
    rows = {r.ticker: r for r in table.read().collect()}
    assert set(rows) == {"BRK.B", "B"} and rows["B"].current_price is None
    assert rows["BRK.B"].m_price_change_last_day_pct == 20.0
    assert rows["BRK.B"].last_updated_datetime == dt.datetime(2024, 1, 5, 15, 31)
