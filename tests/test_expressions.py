"""Edge cases of the scalar expressions and typed projections, on hand-made rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from marketlake import schemas
from marketlake.functions.casting import typed
from marketlake.functions.market_cap import market_cap_class
from marketlake.functions.prices import change_vs_baseline, exact_mean, pct_return, pct_vs_baseline
from marketlake.functions.rounding import rounded
from marketlake.functions.symbols import canonical_symbol, feed_symbol
from marketlake.functions.times import in_session, micros_text, parse_iso, wall_clock_to_utc


@pytest.mark.parametrize(
    "cap, label",
    [
        (200e9 + 1, "Mega Cap"), (200e9, "Large Cap"), (10e9, "Mid Cap"), (2e9, "Small Cap"),
        (250e6, "Micro Cap"), (1.0, "Micro Cap"), (-1.0, "Micro Cap"),
        (0.0, "Not Provided"), (None, "Not Provided"),
    ],
)
def test_market_cap_class(spark, cap, label):
    df = spark.createDataFrame([(cap,)], "cap double")
    assert df.select(market_cap_class(F.col("cap"))).first()[0] == label


def test_symbols(spark):
    df = spark.createDataFrame([("BRK-B",), ("BRK.B",), ("AAPL",)], "s string")
    rows = df.select(canonical_symbol(F.col("s")), feed_symbol(F.col("s"))).collect()
    assert [tuple(r) for r in rows] == [("BRK.B", "BRK-B"), ("BRK.B", "BRK-B"), ("AAPL", "AAPL")]


def test_changes_guard_zero_and_null_baselines(spark):
    df = spark.createDataFrame([(10.0, 8.0), (10.0, 0.0), (10.0, None), (None, 8.0)], "a double, b double")
    rows = df.select(
        change_vs_baseline(F.col("a"), F.col("b")),
        pct_vs_baseline(F.col("a"), F.col("b")),
        pct_return(F.col("a"), F.col("b")),
    ).collect()
    assert [tuple(r) for r in rows] == [
        (2.0, 25.0, 25.0), (10.0, None, None), (None, None, None), (None, None, None),
    ]


def test_rounding_halves_away_from_zero(spark):
    df = spark.createDataFrame([(0.125,), (-0.125,), (1.005,), (2.5,)], "x double")
    assert [r[0] for r in df.select(rounded(F.col("x"), 2)).collect()] == [0.13, -0.13, 1.0, 2.5]


def test_exact_mean_does_not_depend_on_partitioning(spark):
    df = spark.range(100_000).select((F.col("id") % 977 / 100 + 0.01).alias("p"))
    means = {df.repartition(n).agg(exact_mean(F.col("p"))).first()[0] for n in (1, 3, 8)}
    assert len(means) == 1
    empty = df.where("p < 0").agg(exact_mean(F.col("p"))).first()[0]
    assert empty is None


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Tokyo"])
def test_times_do_not_depend_on_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        texts = [
            "2024-03-10T02:30:00Z", "2024-01-05T09:30:00-05", "2024-01-05T09:30:00.5Z",
            "2024-01-05T09:30:00.123456789Z", "not a time", None,
        ]
        df = spark.createDataFrame([(t,) for t in texts], "t string")
        parsed = [r[0] for r in df.select(micros_text(parse_iso(F.col("t")))).collect()]
        assert parsed == [
            "2024-03-10 02:30:00.000000", "2024-01-05 14:30:00.000000", "2024-01-05 09:30:00.500000",
            "2024-01-05 09:30:00.123456", None, None,
        ]
        wall = F.expr("TIMESTAMP_NTZ '2024-07-01 09:30:00'")
        one = spark.range(1)
        assert one.select(micros_text(wall_clock_to_utc(wall, "America/New_York"))).first()[0].startswith("2024-07-01 13:30")
        assert one.select(micros_text(wall_clock_to_utc(wall, None))).first()[0].startswith("2024-07-01 09:30")
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_session_hours_are_inclusive_and_exclude_weekends(spark):
    times = ["2024-01-05 13:00:00", "2024-01-05 21:59:59", "2024-01-05 12:59:59", "2024-01-05 22:00:00", "2024-01-06 15:00:00"]
    df = spark.createDataFrame([(t,) for t in times], "t string").select(F.col("t").cast("timestamp_ntz").alias("t"))
    assert [r[0] for r in df.select(in_session(F.col("t"))).collect()] == [True, True, False, False, False]


def test_typed_turns_bad_fields_into_null(spark):
    rows = [
        ("A", "2024-01-05", "1.5", "2", "x", "", "123.0"),
        ("B", "05/01/2024", None, "1e3", "4", "5", "9007199254740993"),
        ("C", "2024-02-30", "NaN", "1", "1", "1", "1.5e3x"),
    ]
    out = typed(spark.createDataFrame(rows, schemas.as_text(schemas.STAGING)), schemas.STAGING)
    assert out.schema == schemas.STAGING
    a, b, c = out.orderBy("ticker").collect()
    assert a.snapshot_date == dt.date(2024, 1, 5) and a.low is None and a.close is None and a.volume == 123
    assert b.snapshot_date is None and b.open is None and b.high == 1000.0 and b.volume == 9007199254740993
    assert c.snapshot_date is None and c.volume is None
