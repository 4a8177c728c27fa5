"""Write modes, landing files and the daily batch."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from marketlake import schemas
from marketlake.operators import loads
from marketlake.operators.loads import Lake
from marketlake.operators.snapshots import Snapshots
from marketlake.plans import daily
from marketlake.session import fresh_path, fresh_table, shared_dir
from marketlake.sources import csv_files

DAY, NEXT = dt.date(2024, 1, 5), dt.date(2024, 1, 6)


def staged(spark, rows):
    """(ticker, day, close) -> staging rows."""
    return spark.createDataFrame([(t, d, c, c, c, c, 1) for t, d, c in rows], schemas.STAGING)


def contents(df):
    return sorted(tuple(r) for r in df.collect())


def closes(table):
    return contents(table.select("ticker", F.col("trade_date").cast("string"), "close_price"))


@pytest.fixture()
def fact_table(spark):
    name = loads.create_table(spark, fresh_table(spark, "fact"), schemas.FACT, ("trade_date",))
    rows = staged(spark, [("A", DAY, 1.0), ("B", DAY, 2.0), ("A", NEXT, 3.0)])
    assert loads.overwrite(loads.staging_to_fact(rows), name) == 3
    return name


def test_replacing_a_day_is_idempotent_and_leaves_other_days(spark, fact_table):
    new = loads.staging_to_fact(staged(spark, [("A", DAY, 9.0), ("A", NEXT, 8.0)]))
    for _ in range(2):
        loads.replace_day(new, fact_table, "trade_date", DAY)
        assert closes(spark.table(fact_table)) == [("A", "2024-01-05", 9.0), ("A", "2024-01-06", 3.0)]


def test_an_empty_day_empties_its_partition(spark, fact_table):
    loads.replace_day(loads.staging_to_fact(staged(spark, []), DAY), fact_table, "trade_date", DAY)
    assert closes(spark.table(fact_table)) == [("A", "2024-01-06", 3.0)]


def test_inserts_match_columns_by_name(spark, fact_table):
    shuffled = spark.table(fact_table).select(*reversed(spark.table(fact_table).columns))
    name = loads.create_table(spark, fresh_table(spark, "copy"), schemas.FACT, ("trade_date",))
    assert loads.append(shuffled, name, by=("trade_date",)) == 3
    assert closes(spark.table(name)) == closes(spark.table(fact_table))


def test_create_as_replaces(spark):
    name = fresh_table(spark, "t")
    loads.create_as(spark.range(3), name)
    loads.create_as(spark.range(2).select(F.col("id").alias("n")), name)
    assert spark.table(name).columns == ["n"] and spark.table(name).count() == 2


def test_target_day():
    assert loads.target_day("2024-03-01", 1) == dt.date(2024, 2, 29)
    assert loads.target_day(DAY) == DAY


def test_csv_files_keep_rows_and_types(spark):
    root = fresh_path(spark, "csv")
    rows = staged(spark, [("BRK-B", DAY, 0.1 + 0.2), ("A,\"x\"", NEXT, 1e-7)])
    csv_files.write_daily(rows, root)
    back = csv_files.read_bars(spark, root, DAY.isoformat())
    assert back.schema == schemas.STAGING
    assert [(r.ticker, r.close) for r in back.collect()] == [("BRK.B", 0.1 + 0.2)]
    csv_files.write_csv(rows, csv_files.bars_path(root, None))
    assert {r.ticker for r in csv_files.read_bars(spark, root).collect()} == {"BRK.B", 'A,"x"'}


def test_csv_with_other_columns_is_refused(spark):
    path = fresh_path(spark, "csv")
    csv_files.write_csv(spark.createDataFrame([("A", "x")], "ticker string, other string"), path)
    with pytest.raises(Exception):
        csv_files.read_details(spark, path).collect()


def test_daily_batch_survives_a_retried_load(spark):
    root = fresh_path(spark, "lake")
    lake = Lake(spark, root, prefix=f"t{root[-8:]}_").create().create()
    landing = f"{root}/landing"
    history = staged(spark, [("A", DAY, 1.0), ("B", DAY, 2.0), ("BRK-B", DAY, 5.0)])
    csv_files.write_csv(history, csv_files.bars_path(landing, None))
    csv_files.write_daily(staged(spark, [("A", NEXT, 3.0), ("BRK-B", NEXT, 6.0)]), landing)
    assert daily.load_history(lake, landing) == 3
    for _ in range(2):
        assert daily.load_day(lake, landing, NEXT.isoformat()) == 2
    assert lake.table(daily.RAW).count() == 5  # a retry replaces the file's date
    daily.rebuild_marts(lake)
    assert daily.check(lake, strict=True).where("passed").count() == 4
    assert contents(lake.table(daily.CUMULATIVE)) == [
        ("A", [1.0, 3.0], NEXT), ("B", [2.0], DAY), ("BRK.B", [5.0, 6.0], NEXT),
    ]
    assert {(r.ticker, r.latest_price) for r in lake.table(daily.DIM).collect()} == {("A", 3.0), ("B", 2.0), ("BRK.B", 6.0)}


def test_a_fresh_catalog_finds_the_rows(spark):
    root = fresh_path(spark, "lake")
    lake = Lake(spark, root, prefix=f"t{root[-8:]}_").create()
    loads.overwrite(loads.staging_to_fact(staged(spark, [("A", DAY, 1.0), ("A", NEXT, 2.0)])), lake.name(daily.FACT))
    for name in schemas.TABLES:
        spark.sql(f"DROP TABLE {lake.name(name)}")
    lake.create()
    assert closes(lake.table(daily.FACT)) == [("A", "2024-01-05", 1.0), ("A", "2024-01-06", 2.0)]
    loads.replace_day(loads.staging_to_fact(staged(spark, []), DAY), lake.name(daily.FACT), "trade_date", DAY)
    assert closes(lake.table(daily.FACT)) == [("A", "2024-01-06", 2.0)]


def test_lagged_load_takes_the_day_before(spark):
    root = fresh_path(spark, "lake")
    lake = Lake(spark, root, prefix=f"t{root[-8:]}_").create()
    csv_files.write_daily(staged(spark, [("A", DAY, 1.0), ("A", NEXT, 2.0)]), f"{root}/landing")
    for day in (DAY, NEXT):
        daily.load_day(lake, f"{root}/landing", day.isoformat(), lag_days=1)
    assert closes(lake.table(daily.FACT)) == [("A", "2024-01-05", 1.0)]


def test_details_load(spark):
    root = fresh_path(spark, "lake")
    lake = Lake(spark, root, prefix=f"t{root[-8:]}_").create()
    rows = [("BF-B", "Brown", "S", None, 1.5e9, "Small Cap", "N", "")]
    csv_files.write_csv(spark.createDataFrame(rows, schemas.DETAILS), f"{root}/details")
    assert daily.load_details(lake, f"{root}/details") == 1
    assert tuple(lake.table(daily.DETAILS).first())[:5] == ("BF.B", "Brown", "S", None, 1.5e9)


def test_snapshots_keep_a_few_versions_and_ignore_unfinished_ones(spark):
    view = fresh_table(spark, "served")
    table = Snapshots(spark, fresh_path(spark, "snap"), schemas.CUMULATIVE, keep=2, view=view)
    with pytest.raises(ValueError):
        table.read()

    def rows(x):
        return spark.createDataFrame([("A", [x], DAY)], schemas.CUMULATIVE)

    for version in (-1, 0, 1, 2):
        table.write(version, rows(float(version)))
    assert table.versions() == [1, 2]
    assert table.read().first().price_history == [2.0]
    assert table.read(before=2).first().price_history == [1.0]
    assert spark.table(view).first().price_history == [2.0]
    rows(7.0).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{table.path}/version=3.0")
    assert table.read().first().price_history == [2.0]


def test_shared_dir_follows_the_session(spark):
    assert fresh_path(spark, "x").startswith(shared_dir(spark))
    assert fresh_path(spark, "x") != fresh_path(spark, "x")


def test_two_lakes_of_one_catalog_stay_apart(spark):
    one, other = (Lake(spark, fresh_path(spark, "lake")).create() for _ in range(2))
    row = spark.createDataFrame([("A", 1.0, 1.0, 1.0, 1.0, 5, dt.date(2024, 1, 5))], "ticker string, open_price double, high_price double, low_price double, close_price double, volume long, trade_date date")
    loads.append(row, one.name("stg.fact_daily_stock_price"), by=("trade_date",))
    assert one.prefix != other.prefix
    assert one.table("stg.fact_daily_stock_price").count() == 1
    assert other.table("stg.fact_daily_stock_price").count() == 0
    again = Lake(spark, one.root).create()
    assert again.prefix == one.prefix and again.table("stg.fact_daily_stock_price").count() == 1
    with pytest.raises(ValueError, match="another lake"):
        Lake(spark, fresh_path(spark, "lake"), prefix=one.prefix)
    with pytest.raises(ValueError, match="lies in"):
        loads.create_table(spark, one.name("stg.fact_daily_stock_price"), schemas.FACT, ("trade_date",), other.root)
