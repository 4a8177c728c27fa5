"""Accepted and rejected lines are all lines, with file, text and reason."""

from marketlake.operators.loads import Lake
from marketlake.plans import daily
from marketlake.session import fresh_path
from marketlake.sources import quarantine

HEADER = "ticker,snapshot_date,open,high,low,close,volume"
GOOD = ["A,2024-01-05,1,2,0.5,1.5,10", "B-C,2024-01-05,x,2,0.5,1.5,10"]
BAD = {
    "A,2024-01-05,1,2": quarantine.MALFORMED,
    "A,2024-01-05,1,2,3,4,5,6": quarantine.MALFORMED,
    ",2024-01-05,1,2,0.5,1.5,10": quarantine.NO_TICKER,
    "A,05.01.2024,1,2,0.5,1.5,10": quarantine.BAD_DATE,
    ",,1,2,0.5,1.5,10": quarantine.NO_TICKER,
}


def land(spark, lines):
    root = fresh_path(spark, "landing")
    spark.createDataFrame([("\n".join([HEADER, *lines]),)], "value string").coalesce(1).write.text(f"{root}/daily/ds=2024-01-05")
    return root


def test_accepted_and_rejected_are_all_lines(spark):
    checked = quarantine.checked_bars(spark, land(spark, [*GOOD, "", *BAD]), "2024-01-05")
    kept = sorted(map(tuple, quarantine.accepted(checked).select("ticker", "open", "volume").collect()), key=str)
    lost = quarantine.rejected(checked).collect()
    assert kept == [("A", 1.0, 10), ("B.C", None, 10)]
    assert sorted((r.line, r.reason) for r in lost) == sorted(BAD.items())
    assert all("ds=2024-01-05" in r.file for r in lost)
    assert checked.count() == len(GOOD) + len(BAD) == quarantine.accepted(checked).count() + quarantine.rejected(checked).count()


def test_a_file_without_lines(spark):
    assert quarantine.checked_bars(spark, land(spark, []), "2024-01-05").count() == 0


def test_the_daily_load_keeps_rejects(spark):
    root = fresh_path(spark, "lake")
    lake = Lake(spark, f"{root}/lake").create()
    for _ in range(2):  # a repeated load replaces its rejects
        assert daily.load_day(lake, land(spark, [*GOOD, *BAD]), "2024-01-05", rejects=f"{root}/rejects") == 2
    assert spark.read.parquet(f"{root}/rejects").count() == len(BAD)
    assert lake.table(daily.FACT).count() == 2
