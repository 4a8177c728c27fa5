"""The current-day table by keyed state: order of event time, restarts, late records, expiry."""

import datetime as dt

import pytest

from marketlake import schemas
from marketlake.operators.buckets import BucketedTable
from marketlake.session import fresh_path
from marketlake.sources import inline
from marketlake.streaming import current_day as live
from marketlake.streaming.keyed_state import start_keyed_state

DAY = dt.date(2024, 1, 5)


def record(ticker, price, hour, day=DAY):
    at = None if hour is None else dt.datetime(day.year, day.month, day.day, hour)
    return (ticker, DAY, price, price, None, price, 1, at)


@pytest.fixture()
def few_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield spark
    spark.conf.set("spark.sql.shuffle.partitions", before)


def test_state_outlives_a_restart_and_late_records_are_dropped(few_partitions):
    spark = few_partitions
    landing, checkpoint = fresh_path(spark, "landing"), fresh_path(spark, "checkpoint")
    table = BucketedTable(spark, fresh_path(spark, "state"), schemas.CURRENT_DAY, buckets=4)
    table.write(live.SEED_VERSION, inline.current_day_values(spark, [record("SEED", 1.0, 12), record("QUIET", 2.0, None)]))

    def drain(*rows):
        inline.current_day_values(spark, list(rows)).coalesce(1).write.mode("append").parquet(landing)
        query = start_keyed_state(live.price_records(spark, landing), table, checkpoint, "2 hours", dt.timedelta(hours=4))
        query.awaitTermination()
        return {(r.ticker, r.last_price) for r in table.read().collect()}

    # Older than the seed; a missing time; several records of one key in one batch.
    first = drain(record("SEED", 9.0, 11), record("QUIET", 3.0, 9), record("A", 5.0, 13), record("A", 6.0, 14), record("A", 4.0, 12))
    assert first == {("SEED", 1.0), ("QUIET", 3.0), ("A", 6.0)}
    # A new query on the same checkpoint still knows that A is newer than this record.
    second = drain(record("A", 7.0, 13), record("B", 1.0, 14))
    assert second == {("SEED", 1.0), ("QUIET", 3.0), ("A", 6.0), ("B", 1.0)}
    # The watermark stands two hours behind the newest record.
    assert ("C", 1.0) not in drain(record("C", 1.0, 11), record("B", 2.0, 20))
    versions = table.versions()
    assert ("D", 1.0) not in drain(record("D", 1.0, 17))
    assert table.versions() == versions  # nothing changed, so nothing was written
    states = spark.read.format("statestore").option("stateVarName", "newest").load(checkpoint)
    known = {r["key"]["ticker"]: r["value"]["last_price"] for r in states.collect()}
    # SEED, A and QUIET were last heard of more than four hours before the watermark.
    assert known == {"B": 2.0}
    assert drain(record("E", 1.0, 21)) == {("SEED", 1.0), ("QUIET", 3.0), ("A", 6.0), ("B", 2.0), ("E", 1.0)}


def test_ties_do_not_depend_on_arrival(few_partitions):
    spark = few_partitions
    found = []
    tied = [record("A", float(price), 15) for price in range(5)]
    for rows in (tied, tied[::-1]):
        landing = fresh_path(spark, "landing")
        for row in rows:
            inline.current_day_values(spark, [row]).coalesce(1).write.mode("append").parquet(landing)
        table = BucketedTable(spark, fresh_path(spark, "state"), schemas.CURRENT_DAY, buckets=4)
        table.write(live.SEED_VERSION, inline.current_day_values(spark, [record("Z", 0.0, 1)]))
        start_keyed_state(live.price_records(spark, landing), table, fresh_path(spark, "checkpoint")).awaitTermination()
        found.append({tuple(r) for r in table.read().collect()})
    assert found[0] == found[1] and len(found[0]) == 2
