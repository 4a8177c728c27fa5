"""Averages over any window from two rows per ticker: a mart of running totals.

For every trading date the mart has one row per ticker that has traded by then: the exact total and
the number of its closes so far, and its last close. The sum over a window is the total at its end less
the total at its beginning, so a baseline of any length, as of any date, reads the rows of two
dates instead of all bars between them. Dates are looked up as of: the greatest one not after a bound.

Rows are stored by month, in date order. A ledger names the writes that count and the dates
they hold; it is put in place by a rename, so a write that died is not seen, and a repeated one
does not count twice.
"""

from __future__ import annotations

import datetime as dt
import json
import re
from bisect import bisect_right

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql import types as T

from marketlake import files
from marketlake.functions.prices import exact, mean_of
from marketlake.functions.rounding import rounded
from marketlake.operators.baselines import DEFAULT_WINDOWS, average_name

SCHEMA = T.StructType(
    [
        T.StructField("ticker", T.StringType()),
        T.StructField("trade_date", T.DateType()),
        T.StructField("close_total", T.DecimalType(38, 12)),
        T.StructField("priced", T.LongType()),
        T.StructField("last_close", T.DoubleType()),
    ]
)
_LEDGER = re.compile(r"ledger\.(\d+)\.json$")


class RunningTotals:
    """The mart below ``path``. One writer."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _ledger(self) -> tuple[int, dict]:
        numbers = [int(m.group(1)) for m in map(_LEDGER.match, files.names_in(self.spark, self.path)) if m]
        if not numbers:
            return -1, {"writes": [], "dates": []}
        return max(numbers), json.loads(files.read_text(self.spark, f"{self.path}/ledger.{max(numbers)}.json"))

    def dates(self) -> list[dt.date]:
        """All trading dates of the mart, in order."""
        return [dt.date.fromisoformat(d) for d in self._ledger()[1]["dates"]]

    def as_of(self, bound: dt.date) -> dt.date | None:
        """The greatest trading date not after ``bound``."""
        dates = self.dates()
        at = bisect_right(dates, bound)
        return dates[at - 1] if at else None

    def rows(self, dates: list[dt.date]) -> DataFrame:
        """The rows of some dates; other months are not opened."""
        _, ledger = self._ledger()
        if not dates or not ledger["writes"]:
            return self.spark.createDataFrame([], SCHEMA)
        stored = T.StructType([*SCHEMA.fields, T.StructField("write", T.StringType()), T.StructField("month", T.StringType())])
        found = self.spark.read.schema(stored).parquet(f"{self.path}/rows").where(
            F.col("write").isin(ledger["writes"])
            & F.col("month").isin(sorted({_month(d) for d in dates}))
            & F.col("trade_date").isin(dates)
        )
        return found.select(*SCHEMA.fieldNames())

    def fold(self, fact: DataFrame) -> list[dt.date]:
        """Add all dates of the fact behind the mart's last one; returns them. Earlier dates are left alone:
        after a correction the mart is made anew, in another folder."""
        known = self.dates()
        bars = fact.where(F.col("trade_date") > F.lit(known[-1])) if known else fact.where("trade_date IS NOT NULL")
        new = sorted(r[0] for r in bars.select("trade_date").distinct().collect())
        if not new:
            return []
        carried = self.rows(known[-1:]).select("ticker", F.lit(-1).alias("place"), "close_total", "priced", "last_close")
        number, ledger = self._ledger()
        write = f"w{number + 1}"
        while files.exists(self.spark, f"{self.path}/rows/write={write}"):
            write += "_"  # left behind by a fold that died
        month = F.date_format("trade_date", "yyyy-MM")
        dense = _dense(bars, new, carried).withColumns({"write": F.lit(write), "month": month})
        dense.repartition("month").sortWithinPartitions("month", "trade_date").write.mode("append").partitionBy(
            "write", "month"
        ).parquet(f"{self.path}/rows")
        ledger = {"writes": [*ledger["writes"], write], "dates": [*ledger["dates"], *(d.isoformat() for d in new)]}
        files.write_text(self.spark, f"{self.path}/ledger.{number + 1}.json", json.dumps(ledger))
        return new


def _month(date: dt.date) -> str:
    return f"{date:%Y-%m}"


def _dense(bars: DataFrame, dates: list[dt.date], carried: DataFrame) -> DataFrame:
    """One row per ticker and date, from the bars of these dates and the rows before them.

    Each row stands from its date's place to the one before the ticker's next row, and is copied over those.
    """
    places = bars.sparkSession.createDataFrame([(d, n) for n, d in enumerate(dates)], "trade_date date, place int")
    close = exact(F.col("close_price"))
    steps = bars.join(places, "trade_date").select(
        "ticker",
        "place",
        F.coalesce(close.cast("decimal(38,12)"), F.lit(0).cast("decimal(38,12)")).alias("close_total"),
        close.isNotNull().cast("bigint").alias("priced"),
        F.col("close_price").alias("last_close"),
    )
    in_order = Window.partitionBy("ticker").orderBy("place")
    so_far = in_order.rowsBetween(Window.unboundedPreceding, 0)
    until = F.coalesce(F.lead("place").over(in_order), F.lit(len(dates))) - 1
    summed = steps.unionByName(carried).select(
        "ticker",
        F.greatest("place", F.lit(0)).alias("first"),
        until.alias("until"),
        F.sum("close_total").over(so_far).cast("decimal(38,12)").alias("close_total"),
        F.sum("priced").over(so_far).alias("priced"),
        "last_close",
    )
    spread = summed.where("until >= first").withColumn("place", F.explode(F.sequence("first", "until")))
    return spread.join(places, "place").select(*SCHEMA.fieldNames())


def baselines_asof(
    totals: RunningTotals, as_of: dt.date, windows: tuple[int, ...] = DEFAULT_WINDOWS
) -> DataFrame:
    """What ``trailing_baselines`` gives for a date: the last close, and averages over the ``n`` calendar days
    that end there. Reads the rows of one date, and of one more for each window."""
    end = totals.as_of(as_of)
    starts = {n: totals.as_of(as_of - dt.timedelta(days=n)) for n in windows}
    rows = totals.rows(sorted({d for d in (end, *starts.values()) if d is not None}))

    def at(date: dt.date | None, column: str):
        return F.max(F.when(F.col("trade_date") == F.lit(date).cast("date"), F.col(column)))

    found = {"_end_total": at(end, "close_total"), "_end_priced": at(end, "priced"), "close_price_last_day": at(end, "last_close")}
    for n, start in starts.items():
        found |= {f"_total_{n}": F.coalesce(at(start, "close_total"), F.lit(0)), f"_priced_{n}": F.coalesce(at(start, "priced"), F.lit(0))}
    wide = rows.groupBy("ticker").agg(*(c.alias(name) for name, c in found.items()))
    return wide.select(
        "ticker",
        "close_price_last_day",
        *(
            rounded(
                mean_of(F.col("_end_total") - F.col(f"_total_{n}"), F.col("_end_priced") - F.col(f"_priced_{n}")), 4
            ).alias(average_name(n))
            for n in windows
        ),
    )
