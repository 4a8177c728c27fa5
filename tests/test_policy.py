"""Numbers that are not finite, ties, replays, corrected files and reports over the lake."""

import datetime as dt

import pytest
from pyspark.sql import functions as F, types as T

from marketlake import jobs, schemas
from marketlake.functions.casting import parse_field
from marketlake.functions.market_cap import market_cap_class
from marketlake.functions.prices import exact_dollar_volume, exact_mean
from marketlake.operators import loads
from marketlake.operators.cleaning import one_per_key
from marketlake.operators.history import append_day, dim_daily
from marketlake.operators.latest import latest_per_key, ranked_latest
from marketlake.operators.loads import Lake
from marketlake.operators.snapshots import Snapshots
from marketlake.plans import daily, dashboards, reports
from marketlake.session import fresh_path
from marketlake.sources import csv_files, wide

NAN, INF = float("nan"), float("inf")
DAY, NEXT = dt.date(2024, 1, 5), dt.date(2024, 1, 8)


def bars(spark, rows):
    return spark.createDataFrame([(t, d, c, c, c, c, 1) for t, d, c in rows], schemas.STAGING)


def test_non_finite_numbers_are_missing(spark):
    texts = spark.createDataFrame([("NaN",), ("Infinity",), ("-inf",), ("1.5",)], "t string")
    assert [r[0] for r in texts.select(parse_field(F.col("t"), T.DoubleType())).collect()] == [None, None, None, 1.5]
    prices = spark.createDataFrame([(10.0,), (NAN,), (INF,), (None,), (4e-7,)], "p double")
    assert prices.where("p < 11").agg(exact_mean(F.col("p"))).first()[0] == pytest.approx(5.0000002)
    assert prices.where("p < 1").agg(exact_mean(F.col("p"))).first()[0] == pytest.approx(4e-7)
    caps = spark.createDataFrame([(NAN,), (INF,)], "c double").select(market_cap_class(F.col("c")))
    assert [r[0] for r in caps.collect()] == ["Not Provided"] * 2
    moves = spark.createDataFrame([("A", 1.0, NAN), ("B", 1.0, 2.0)], "ticker string, current_price double, m double")
    assert [r.ticker for r in reports.top_moves(moves, "m", above=True).collect()] == ["B"]
    volume = spark.createDataFrame([(0.00004, 10**9), (NAN, 1)], "p double, v bigint")
    assert volume.agg(F.sum(exact_dollar_volume(F.col("p"), F.col("v"))).cast("double")).first()[0] == 40_000.0


def test_wide_frames_with_volume_gaps(spark):
    rows = [(DAY, 1.0, 1.0, 1.0, 1.0, NAN, 2.0, 2.0, 2.0, 2.0, 7.0)]
    names = ["Date", *(f"{s}_{f}" for s in ("A", "B") for f in ("Open", "High", "Low", "Close", "Volume"))]
    assert [(r.ticker, r.volume) for r in wide.melt_bars(spark.createDataFrame(rows, names)).collect()] == [("B", 7)]


@pytest.mark.parametrize("latest_of", [latest_per_key, ranked_latest])
def test_ties_do_not_depend_on_order(spark, latest_of):
    at = dt.datetime(2024, 1, 5, 12)
    rows = [("A", at, float(p), None if p % 2 else 1) for p in range(20)] + [("B", None, 1.0, 1), ("B", None, 2.0, None)]
    frame = spark.createDataFrame(rows, "k string, ts timestamp_ntz, p double, n int")
    found = {tuple(sorted(map(str, latest_of(f, ["k"], "ts").collect()))) for f in (frame.repartition(1), frame.repartition(5), frame.orderBy(F.desc("p")))}
    assert len(found) == 1


def test_one_per_key_tells_nulls_apart(spark):
    frame = spark.createDataFrame([("A", None, 1.0), ("A", 1.0, None)], "k string, a double, b double")
    assert {tuple(one_per_key(f, ["k"]).first()) for f in (frame, frame.orderBy(F.desc("a")))}.__len__() == 1


def test_a_replay_leaves_readers_their_files(spark):
    table = Snapshots(spark, fresh_path(spark, "snap"), schemas.CUMULATIVE)
    rows = lambda x: spark.createDataFrame([("A", [x], DAY)], schemas.CUMULATIVE)
    first = table.write(0, rows(1.0))
    table.write(0, rows(2.0))
    assert first.first().price_history == [1.0] and table.read().first().price_history == [2.0]

    def refuse(_):
        raise ValueError("too few rows")

    with pytest.raises(ValueError):
        table.write(1, rows(3.0), check=refuse)
    assert table.versions() == [0]


def test_corrected_and_bad_rows(spark):
    root = fresh_path(spark, "lake")
    lake = Lake(spark, root, prefix=f"p{root[-8:]}_").create()
    landing = f"{root}/landing"
    csv_files.write_daily(bars(spark, [("A", DAY, 1.0)]), landing)
    daily.load_day(lake, landing, DAY.isoformat())
    text = [("A", DAY.isoformat(), "2", "2", "2", "2", "1"), ("B", "05/01/2024", "1", "1", "1", "1", "1")]
    spark.createDataFrame(text, schemas.as_text(schemas.STAGING)).write.mode("overwrite").option("header", True).csv(csv_files.bars_path(landing, DAY.isoformat()))
    daily.load_day(lake, landing, DAY.isoformat())
    assert [r.close_price for r in lake.table(daily.FACT).collect()] == [2.0]
    daily.rebuild_marts(lake)
    report = {r.check_name: r for r in daily.check(lake, landing=landing, ds=DAY.isoformat()).collect()}
    assert report["rejected rows"].observed == 1 and not report["rejected rows"].passed
    with pytest.raises(ValueError):
        daily.check(lake, strict=True, landing=landing, ds=DAY.isoformat())
    csv_files.write_csv(bars(spark, [("A", dt.date(2024, 1, 4), 0.5)]), f"{landing}/history")
    daily.load_history(lake, landing)
    assert lake.table(daily.FACT).count() == 2  # the later date stays


@pytest.mark.parametrize("mode", ["static", "dynamic"])
def test_overwrite_replaces_the_table_in_any_session(spark, mode):
    root = fresh_path(spark, "lake")
    lake = Lake(spark, root, prefix=f"p{root[-8:]}_").create()
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    spark.conf.set(key, mode)
    try:
        for day in (DAY, NEXT):
            loads.overwrite(loads.staging_to_fact(bars(spark, [("A", day, 1.0)])), lake.name(daily.FACT), by=("trade_date",))
        assert [r.trade_date for r in lake.table(daily.FACT).collect()] == [NEXT]
    finally:
        spark.conf.set(key, before)


def test_append_day_equals_a_rebuild(spark):
    old = loads.staging_to_fact(bars(spark, [("A", DAY, 1.0), ("B", DAY, 5.0)]))
    new = loads.staging_to_fact(bars(spark, [("A", NEXT, None), ("C", NEXT, 2.0)]))
    got = {r.ticker: r for r in append_day(dim_daily(old), new).collect()}
    assert got["A"].price_history == [1.0, None] and got["B"].last_updated == DAY and got["C"].historic_low == 2.0


def test_reports_over_the_lake(spark):
    root = fresh_path(spark, "lake")
    lake = Lake(spark, f"{root}/lake").create()
    landing = f"{root}/landing"
    csv_files.write_csv(bars(spark, [("A", DAY, 1.0), ("A", NEXT, 2.0), ("B", DAY, 4.0), ("B", NEXT, 4.0)]), f"{landing}/history")
    daily.load_history(lake, landing)
    daily.rebuild_marts(lake)
    details = [("A", "Alpha", "S", "I", 3e11, "Mega Cap", "N", "C"), ("B", "Beta", "R", "I", 3e9, "Mid Cap", "N", "C")]
    csv_files.write_csv(spark.createDataFrame(details, schemas.DETAILS), f"{root}/details")
    daily.load_details(lake, f"{root}/details")
    charts = dashboards.historical(lake)
    assert {(r.sector, r.avg_return_pct) for r in charts["sector_performance"].collect()} == {("S", 100.0), ("R", 0.0)}
    assert [r.avg_close for r in dashboards.historical(lake, sectors=["S"])["market_trend"].orderBy("trade_date").collect()] == [1.0, 2.0]
    assert {r.tbl: r.cnt for r in daily.counts(lake).collect()}[daily.DIM] == 2
    jobs.main(["report", "--lake", f"{root}/lake", "--out", f"{root}/out", "--sector", "R"])
    assert [r.ticker for r in spark.read.parquet(f"{root}/out/stock_ranking").collect()] == ["B"]
