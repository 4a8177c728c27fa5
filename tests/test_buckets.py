"""Bucketed tables: merges that read and write only what they touch."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from marketlake import files, schemas
from marketlake.operators.buckets import BucketedTable
from marketlake.operators.merge import merge_update, merge_upsert
from marketlake.operators.quality import require
from marketlake.session import fresh_path, fresh_table
from marketlake.sources import inline
from marketlake.streaming import current_day as live

DAY = dt.date(2024, 1, 5)
KEYS = ["ticker", "trade_date"]


def records(spark, *rows):
    at = dt.datetime(2024, 1, 5, 15)
    return inline.current_day_values(spark, [(t, DAY, p, p, p, p, 1, at) for t, p in rows])


def prices(df):
    return {(r.ticker, r.last_price) for r in df.collect()}


@pytest.fixture()
def table(spark):
    made = BucketedTable(spark, fresh_path(spark, "buckets"), schemas.CURRENT_DAY, buckets=8)
    made.write(-1, records(spark, *((f"T{n}", float(n)) for n in range(100))))
    return made


def upsert(table, version, source, **options):
    return table.change(version, source, lambda rows: merge_upsert(rows, source, KEYS), **options)


def test_one_ticker_reads_and_writes_one_bucket(spark, table):
    before = table.writes()
    assert len(before) == 8
    source = records(spark, ("T3", 9.0))
    seen = []
    table.change(0, source, lambda rows: seen.append(rows) or merge_upsert(rows, source, KEYS))
    plan = seen[0]._jdf.queryExecution().executedPlan().toString()
    filters = next(line for line in plan.splitlines() if "PartitionFilters" in line)
    assert "bucket" in filters.split("PartitionFilters: [")[1] and seen[0].count() < 40
    after = table.writes()
    assert [b for b in after if after[b] != before[b]] == table.touched(source)
    assert len(files.names_in(spark, f"{table.path}/rows/bucket={table.touched(source)[0]}")) == 2
    assert ("T3", 9.0) in prices(table.read()) and table.read().count() == 100


def test_equals_a_merge_of_the_whole_table(spark, table):
    whole = table.read()
    for version, source in enumerate([records(spark, ("T1", 5.0), ("new", 1.0)), records(spark, ("new", 2.0), ("T99", 7.0), ("other", 3.0))]):
        whole = merge_upsert(whole, source, KEYS)
        upsert(table, version, source)
    assert sorted(map(tuple, table.read().collect())) == sorted(map(tuple, whole.collect()))
    known = records(spark, ("T5", 50.0), ("unknown", 1.0)).select("ticker", "last_price")
    updated = table.change(5, known, lambda rows: merge_update(rows, known, ["ticker"]))
    assert ("T5", 50.0) in prices(updated) and updated.count() == 102


def test_a_replayed_version_starts_from_the_one_before(spark, table):
    upsert(table, 0, records(spark, ("A", 1.0)))
    for price in (2.0, 3.0):
        upsert(table, 1, records(spark, ("A", price), ("B", price)))
    assert {("A", 3.0), ("B", 3.0)} <= prices(table.read()) and table.versions() == [-1, 0, 1]
    assert ("A", 1.0) in prices(table.read(before=1)) and table.read().count() == 102


def test_a_failed_check_leaves_the_table(spark, table):
    before = prices(table.read())

    def never(rows):
        require(rows.agg((F.count(F.lit(1)) < 0).alias("passed")))

    with pytest.raises(ValueError, match="data-quality"):
        upsert(table, 0, records(spark, ("A", 1.0)), check=never)
    assert prices(table.read()) == before and table.versions() == [-1]
    upsert(table, 0, records(spark, ("A", 4.0)))
    assert ("A", 4.0) in prices(table.read()) and table.read().count() == 101


def test_old_versions_go_but_not_what_newer_ones_carry(spark):
    view = fresh_table(spark, "served")
    table = BucketedTable(spark, fresh_path(spark, "buckets"), schemas.CURRENT_DAY, buckets=4, keep=2, view=view)
    table.write(-1, records(spark, *((f"T{n}", 1.0) for n in range(20))))
    for version in range(4):
        upsert(table, version, records(spark, ("T0", 10.0 + version)))
        assert prices(spark.table(view)) == prices(table.read())
    assert table.versions() == [2, 3] and table.read().count() == 20 and ("T0", 13.0) in prices(table.read())
    (bucket,) = table.touched(records(spark, ("T0", 0.0)))
    assert len(files.names_in(spark, f"{table.path}/rows/bucket={bucket}")) == 2
    again = BucketedTable(spark, table.path, schemas.CURRENT_DAY, buckets=99)
    assert again.buckets == 4 and prices(again.read()) == prices(table.read())


def test_an_empty_table_and_empty_batches(spark):
    table = BucketedTable(spark, fresh_path(spark, "buckets"), schemas.CURRENT_DAY)
    with pytest.raises(ValueError, match="no version"):
        table.read()
    table.write(-1, records(spark).limit(0))
    assert table.read().count() == 0
    upsert(table, 0, records(spark))
    upsert(table, 1, records(spark, (None, 1.0), ("A", 2.0)))
    assert prices(table.read()) == {(None, 1.0), ("A", 2.0)}


def test_a_stream_keeps_a_bucketed_table(spark, table):
    landing, checkpoint = (fresh_path(spark, n) for n in ("landing", "checkpoint"))
    for price in (1.5, 2.5):
        records(spark, ("T7", price), ("Z", price)).coalesce(1).write.mode("append").parquet(landing)
        live.start_upserts(live.price_records(spark, landing, 1), table, checkpoint, min_rows=1).awaitTermination()
    assert {("T7", 2.5), ("Z", 2.5)} <= prices(table.read()) and table.versions() == [-1, 0, 1]
