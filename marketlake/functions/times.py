"""Timestamps are stored zone-less, as UTC wall-clock time."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

ISO_WITH_ZONE = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSSSSS]X"


def parse_iso(text: Column) -> Column:
    """ISO text with a zone, with or without fractional seconds -> UTC wall clock.

    Counting microseconds from the epoch keeps the result independent of the
    session time zone (a plain cast would go through it).
    """
    micros = F.unix_micros(F.try_to_timestamp(text, F.lit(ISO_WITH_ZONE)))
    since_epoch = F.make_dt_interval(secs=(micros / F.lit(1_000_000).cast("decimal(7,0)")).cast("decimal(18,6)"))
    return F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'") + since_epoch


def wall_clock_to_utc(ts: Column, zone: str | None) -> Column:
    """Wall-clock time in ``zone`` -> UTC wall clock; naive times (no zone) are kept."""
    if zone is None:
        return ts
    return F.convert_timezone(F.lit(zone), F.lit("UTC"), ts)


def micros_text(ts: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss.SSSSSS`` with all six digits."""
    text = ts.cast("string")
    dotted = F.when(F.instr(text, ".") == 0, F.concat(text, F.lit("."))).otherwise(text)
    return F.rpad(dotted, 26, "0")


def in_session(ts: Column, first_hour: int = 13, last_hour: int = 21) -> Column:
    """Monday to Friday, hours inclusive, on the UTC clock."""
    return (F.weekday(ts) < 5) & F.hour(ts).between(first_hour, last_hour)
