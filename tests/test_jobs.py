"""The jobs, from landed files to the served tables."""

import datetime as dt

from pyspark.sql import functions as F

from marketlake import jobs, schemas
from marketlake.operators.loads import Lake
from marketlake.plans import daily
from marketlake.session import fresh_path
from marketlake.sources import csv_files, inline

FIRST, SECOND, TODAY = (dt.date(2024, 1, day) for day in (4, 5, 8))


def bars(spark, rows):
    return spark.createDataFrame([(t, d, c, c, c, c, 1) for t, d, c in rows], schemas.STAGING)


def test_from_files_to_live_tables(spark):
    root = fresh_path(spark, "jobs")
    csv_files.write_csv(bars(spark, [("A", FIRST, 8.0), ("B", FIRST, 4.0)]), f"{root}/landing/history")
    csv_files.write_daily(bars(spark, [("A", SECOND, 10.0)]), f"{root}/landing")
    details = [("A", "Alpha", "S", "I", 3e11, "Mega Cap", "N", "C")]
    csv_files.write_csv(spark.createDataFrame(details, schemas.DETAILS), f"{root}/details")
    common = ["--lake", f"{root}/lake"]
    jobs.main(["history", *common, "--landing", f"{root}/landing"])
    jobs.main(["details", *common, "--landing", f"{root}/details"])
    jobs.main(["day", *common, "--landing", f"{root}/landing", "--ds", SECOND.isoformat(), "--strict"])
    lake = Lake(spark, f"{root}/lake")
    assert {(r.ticker, r.latest_price) for r in lake.table(daily.DIM).collect()} == {("A", 10.0), ("B", 4.0)}

    at = dt.datetime(2024, 1, 8, 15)
    record = ("A", TODAY, 12.0, 11.0, 12.5, 10.5, 100, at)
    inline.current_day_values(spark, [record]).write.parquet(f"{root}/records")
    for _ in range(2):
        jobs.main(["prices", *common, "--landing", f"{root}/records", "--ds", TODAY.isoformat(), "--min-rows", "1"])
    served = lake.table(jobs.PRICES)
    assert served.dtypes == [(f.name, f.dataType.simpleString()) for f in schemas.CURRENT_DAY]
    assert {(r.ticker, r.trade_date, r.last_price) for r in served.collect()} == {
        ("A", SECOND, 10.0), ("B", FIRST, 4.0), ("A", TODAY, 12.0),
    }

    document = '{"bars": {"A": {"c": 12, "t": "2024-01-08T15:00:00Z"}}}'
    spark.createDataFrame([(document,)], "value string").write.text(f"{root}/documents")
    jobs.main(["metrics", *common, "--landing", f"{root}/documents", "--ds", TODAY.isoformat()])
    rows = {r.ticker: r for r in lake.table(jobs.METRICS).collect()}
    assert rows["A"].m_price_change_last_day_pct == 20.0 and rows["A"].last_updated_datetime == at
    assert rows["A"].close_price_avg_last_90_days == 9.0 and rows["A"].market_cap_description == "Mega Cap"
    assert rows["B"].current_price is None and rows["B"].market_cap_description == "Not Provided"
    assert lake.table(jobs.METRICS).where(F.col("current_price").isNotNull()).count() == 1
