"""Trading hours of an exchange: open and close per date on its own clock, as intervals in UTC.

Weekdays have the regular hours; exceptions name dates of other hours, and holidays by a NULL opening. The
zone's rules turn them into UTC, so summer time moves the interval of a date and not the clock of the records.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

ZONE = "America/New_York"
OPENS, CLOSES = "09:30", "16:00"
EXCEPTIONS = "trade_date date, opens string, closes string"


def days_between(bounds: DataFrame, first: Column, last: Column) -> DataFrame:
    """One row per date from `first` to `last` of a one-row frame; none where a bound is NULL."""
    return bounds.where(first <= last).select(F.explode(F.sequence(first, last)).alias("trade_date"))


def trading_hours(
    days: DataFrame, exceptions: DataFrame | None = None, zone: str = ZONE, opens: str = OPENS, closes: str = CLOSES
) -> DataFrame:
    """(trade_date, opens_at, closes_at) in UTC of the dates that are traded. Of exceptions that repeat a date
    the earliest opening and closing hold, NULL before all; weekends are closed unless an exception opens them."""
    regular = F.weekday("trade_date") < 5
    if exceptions is None:
        hours = days.select("trade_date", F.when(regular, F.lit(opens)).alias("opens"), F.lit(closes).alias("closes"))
    else:
        closed = F.count(F.when(F.col("opens").isNull() | F.col("closes").isNull(), 1)) > 0
        other = exceptions.groupBy("trade_date").agg(
            closed.alias("closed"), F.min("opens").alias("other_opens"), F.min("closes").alias("other_closes")
        )
        known = F.col("closed").isNotNull()
        hours = days.join(other, "trade_date", "left").select(
            "trade_date",
            F.when(known & ~F.col("closed"), F.col("other_opens")).when(~known & regular, F.lit(opens)).alias("opens"),
            F.coalesce("other_closes", F.lit(closes)).alias("closes"),
        )

    def utc(clock: str) -> Column:
        local = F.to_timestamp_ntz(F.concat_ws(" ", F.col("trade_date").cast("string"), clock), F.lit("yyyy-MM-dd HH:mm"))
        return F.convert_timezone(F.lit(zone), F.lit("UTC"), local)

    traded = hours.where(F.col("opens").isNotNull())
    return traded.select("trade_date", utc("opens").alias("opens_at"), utc("closes").alias("closes_at"))


def within_hours(records: DataFrame, ts: str, hours: DataFrame, zone: str = ZONE) -> DataFrame:
    """Records, still or streamed, from the opening to before the closing of their date on the exchange's clock.

    The join is by date, one interval each; records without a time are outside.
    """
    own = hours.select(
        F.col("trade_date").alias("__trade_date"), F.col("opens_at").alias("__opens_at"), F.col("closes_at").alias("__closes_at")
    )
    time = F.col(ts).cast("timestamp_ntz")
    local = F.to_date(F.convert_timezone(F.lit("UTC"), F.lit(zone), time))
    inside = (local == F.col("__trade_date")) & (time >= F.col("__opens_at")) & (time < F.col("__closes_at"))
    return records.join(own, inside, "left_semi")
