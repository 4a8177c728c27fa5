"""Summer, winter, holidays, short days, odd exceptions and records without a time."""

import datetime as dt

from pyspark.sql import functions as F

from marketlake.operators.trading_hours import EXCEPTIONS, days_between, trading_hours, within_hours

D, T = dt.date, dt.datetime


def hours_of(spark, days, exceptions=None):
    frame = spark.createDataFrame([(d,) for d in days], "trade_date date")
    other = None if exceptions is None else spark.createDataFrame(exceptions, EXCEPTIONS)
    return trading_hours(frame, other)


def test_summer_winter_and_exceptions(spark):
    days = [D(2024, 1, 12), D(2024, 7, 12), D(2024, 7, 4), D(2024, 12, 24), D(2024, 7, 6), D(2024, 7, 7), D(2024, 3, 11)]
    other = [(D(2024, 7, 4), None, None), (D(2024, 12, 24), "09:30", "13:00"), (D(2024, 7, 7), "10:00", "11:00"), (D(2024, 7, 4), "09:30", "12:00")]
    got = {r[0]: (r[1], r[2]) for r in hours_of(spark, days, other).collect()}
    assert got == {
        D(2024, 1, 12): (T(2024, 1, 12, 14, 30), T(2024, 1, 12, 21)),
        D(2024, 7, 12): (T(2024, 7, 12, 13, 30), T(2024, 7, 12, 20)),
        D(2024, 12, 24): (T(2024, 12, 24, 14, 30), T(2024, 12, 24, 18)),
        D(2024, 7, 7): (T(2024, 7, 7, 14), T(2024, 7, 7, 15)),
        D(2024, 3, 11): (T(2024, 3, 11, 13, 30), T(2024, 3, 11, 20)),
    }


def test_records_of_the_session(spark):
    hours = hours_of(spark, [D(2024, 1, 12), D(2024, 7, 12)])
    times = [T(2024, 1, 12, 14, 29, 59), T(2024, 1, 12, 14, 30), T(2024, 7, 12, 13, 30), T(2024, 7, 12, 20), T(2024, 7, 12, 19, 59, 59), None, T(2024, 1, 13, 15)]
    rows = spark.createDataFrame(list(enumerate(times)), "n int, ts timestamp_ntz")
    kept = within_hours(rows, "ts", hours)
    assert kept.columns == ["n", "ts"] and {r.n for r in kept.collect()} == {1, 2, 4}
    assert within_hours(rows.limit(0), "ts", hours).count() == within_hours(rows, "ts", hours.limit(0)).count() == 0


def test_days_between(spark):
    bounds = spark.createDataFrame([(D(2024, 2, 28), D(2024, 3, 1))], "a date, b date")
    assert days_between(bounds, F.col("a"), F.col("b")).count() == 3
    assert days_between(bounds.select(F.lit(None).cast("date").alias("a"), "b"), F.col("a"), F.col("b")).count() == 0
