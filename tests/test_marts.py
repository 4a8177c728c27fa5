"""Marts that catch up with the fact: gaps, corrections, runs that died on the way."""

import datetime as dt

import pytest

from marketlake import schemas
from marketlake.operators import loads
from marketlake.operators.history import dim_daily
from marketlake.operators.loads import Lake
from marketlake.operators.snapshots import Snapshots
from marketlake.plans import daily
from marketlake.session import fresh_path

DAYS = [dt.date(2024, 1, n) for n in (2, 3, 4, 5, 8)]


@pytest.fixture()
def lake(spark):
    return Lake(spark, fresh_path(spark, "lake")).create()


def load(lake, day, *bars):
    rows = [(t, day, c, c, c, c, 1) for t, c in bars]
    staged = lake.spark.createDataFrame(rows, schemas.STAGING)
    loads.replace_day(loads.staging_to_fact(staged), lake.name(daily.FACT), "trade_date", day)


def same_as_rebuilt(lake):
    expected = sorted(map(tuple, dim_daily(lake.table(daily.FACT)).collect()))
    assert sorted(map(tuple, lake.table(daily.DIM).collect())) == expected
    assert sorted(map(tuple, lake.table(daily.CUMULATIVE).collect())) == sorted((r[0], r[1], r[5]) for r in expected)
    return expected


def test_dates_of_runs_without_marts_are_folded_in_later(lake):
    assert lake.table(daily.DIM).count() == lake.table(daily.CUMULATIVE).count() == 0
    load(lake, DAYS[0], ("A", 1.0), ("B", 5.0))
    assert daily.update_marts(lake, DAYS[0]) == ["2024-01-02"]
    # Two runs die between the fact and the marts; the third goes through.
    load(lake, DAYS[1], ("A", 2.0))
    load(lake, DAYS[2], ("A", None), ("C", 7.0))
    load(lake, DAYS[3], ("C", 3.0), ("B", 9.0))
    assert daily.update_marts(lake, DAYS[3]) == ["2024-01-03", "2024-01-04", "2024-01-05"]
    rows = {r[0]: r for r in same_as_rebuilt(lake)}
    assert rows["A"][1] == [1.0, 2.0, None] and rows["C"][1] == [7.0, 3.0]
    assert daily.update_marts(lake) == [] and set(daily.folded_dates(lake)) == {d.isoformat() for d in DAYS[:4]}


def test_a_run_that_dies_while_it_writes_leaves_rows_and_ledger(lake, monkeypatch):
    load(lake, DAYS[0], ("A", 1.0))
    daily.update_marts(lake)
    load(lake, DAYS[1], ("A", 2.0))
    with monkeypatch.context() as patched:
        patched.setattr("marketlake.operators.snapshots.files.touch", lambda *a: (_ for _ in ()).throw(OSError("gone")))
        with pytest.raises(OSError, match="gone"):
            daily.update_marts(lake, DAYS[1])
    assert daily.folded_dates(lake) == {"2024-01-02": 1}
    assert [r.price_history for r in lake.table(daily.DIM).collect()] == [[1.0]]
    assert daily.update_marts(lake) == ["2024-01-03"]
    same_as_rebuilt(lake)


def test_corrections_gaps_and_lost_dates_rebuild(lake):
    for day, close in ((DAYS[0], 1.0), (DAYS[2], 3.0)):
        load(lake, day, ("A", close), ("B", close))
    daily.update_marts(lake)
    load(lake, DAYS[1], ("A", 2.0))  # between the others
    assert daily.update_marts(lake, DAYS[1]) == ["2024-01-03"]
    assert {r[0]: r[1] for r in same_as_rebuilt(lake)}["A"] == [1.0, 2.0, 3.0]
    load(lake, DAYS[2], ("A", 4.0), ("B", 4.0))  # as many bars as before
    assert daily.update_marts(lake, DAYS[2]) == ["2024-01-04"]
    same_as_rebuilt(lake)
    load(lake, DAYS[0], ("A", 1.0))  # fewer bars, and nobody says so
    load(lake, DAYS[4], ("B", 8.0))
    assert daily.update_marts(lake, DAYS[4]) == ["2024-01-02", "2024-01-08"]
    same_as_rebuilt(lake)


def test_a_mart_of_the_earlier_layout_makes_room(lake):
    spark, name = lake.spark, lake.name(daily.DIM)
    load(lake, DAYS[0], ("A", 1.0))
    spark.sql(f"DROP VIEW {name}")
    loads.create_table(spark, name, schemas.DIM_DAILY, (), f"{lake.root}/marts/dim_daily_stock_price")
    again = Lake(spark, lake.root).create()
    assert again.table(daily.DIM).count() == 0
    assert daily.update_marts(again) == ["2024-01-02"]
    same_as_rebuilt(again)
    assert isinstance(again.mart(daily.DIM), Snapshots) and again.mart(daily.DIM).versions() == [0]
