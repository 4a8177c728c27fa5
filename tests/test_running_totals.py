"""Baselines out of running totals: as the bars give them, from the rows of few dates."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from marketlake import files
from marketlake.operators.baselines import trailing_baselines
from marketlake.operators.running_totals import RunningTotals, baselines_asof
from marketlake.session import fresh_path

START = dt.date(2023, 11, 20)


@pytest.fixture(scope="module")
def fact(spark):
    rnd = random.Random(1)
    rows = []
    for n in range(120):
        day = START + dt.timedelta(days=n)
        if day.weekday() < 5:
            rows += [(t, day, rnd.choice([None, float("nan"), round(rnd.random() * 100, 3)])) for t in "ABCDE" if rnd.random() < 0.4]
    rows += [("LATE", START + dt.timedelta(days=110), 7.0), (None, START, 5.0)]
    return spark.createDataFrame(rows, "ticker string, trade_date date, close_price double")


def same(got, expected):
    assert sorted(map(str, got.collect())) == sorted(map(str, expected.select(*got.columns).collect()))


def test_equals_the_average_of_the_bars(spark, fact):
    totals = RunningTotals(spark, fresh_path(spark, "totals"))
    assert baselines_asof(totals, START).count() == 0 and totals.as_of(START) is None
    for days in (10, 11, 60, 200):  # in four folds, one of them of one date
        totals.fold(fact.where(F.col("trade_date") <= F.lit(START + dt.timedelta(days=days))))
    assert totals.fold(fact) == [] and len(totals.dates()) == len(set(totals.dates()))
    for days in (-1, 0, 5, 12, 33, 61, 119, 400):
        day = START + dt.timedelta(days=days)
        expected = trailing_baselines(fact, (7, 30, 90), as_of=F.lit(day))
        same(baselines_asof(totals, day, (7, 30, 90)), expected)


def test_reads_two_rows_per_ticker_and_window(spark, fact):
    totals = RunningTotals(spark, fresh_path(spark, "totals"))
    totals.fold(fact)
    day = START + dt.timedelta(days=100)
    end, start = totals.as_of(day), totals.as_of(day - dt.timedelta(days=30))
    assert totals.rows([end, start]).groupBy("ticker").count().agg(F.max("count")).first()[0] == 2
    plan = baselines_asof(totals, day, (30,))._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "PartitionFilters" in line)
    assert "month" in scan.split("PartitionFilters: [")[1].split("]")[0]
    assert "trade_date" in scan.split("PushedFilters: [")[1]


def test_a_fold_that_died_does_not_count(spark, fact, monkeypatch):
    totals = RunningTotals(spark, fresh_path(spark, "totals"))
    totals.fold(fact.where(F.col("trade_date") < F.lit(START + dt.timedelta(days=50))))
    before = totals.dates()
    with monkeypatch.context() as patched:
        patched.setattr("marketlake.operators.running_totals.files.write_text", lambda *a: (_ for _ in ()).throw(OSError("gone")))
        with pytest.raises(OSError, match="gone"):
            totals.fold(fact)
    assert totals.dates() == before
    totals.fold(fact)
    day = START + dt.timedelta(days=119)
    same(baselines_asof(totals, day), trailing_baselines(fact, as_of=F.lit(day)))
    assert len(files.names_in(spark, f"{totals.path}/rows")) >= 3
