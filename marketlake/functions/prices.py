"""Price-change expressions. All stay inside generated JVM code."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from marketlake.functions.rounding import rounded


def pct_return(now: Column, start: Column) -> Column:
    """Relative change in percent, unrounded; NULL when ``start`` is zero."""
    return F.try_divide(now - start, start) * 100


def pct_vs_baseline(now: Column, baseline: Column) -> Column:
    """Percent change to two places; NULL when the baseline is NULL or zero."""
    change = rounded(100 * (now - baseline) / baseline, 2)
    return F.when(baseline.isNotNull() & (baseline != 0), change)


def change_vs_baseline(now: Column, baseline: Column) -> Column:
    return rounded(now - baseline, 2)


def exact_dollar_volume(price: Column, volume: Column) -> Column:
    """price x volume as a decimal of ten places, so that a total does not depend on row
    order. NULL for a price that is not finite."""
    return price.try_cast("decimal(22,10)") * volume.try_cast("decimal(15,0)")


def exact(value: Column) -> Column:
    """A double as a decimal of twelve places, NULL when it is not finite. Doubles add up
    differently in every partitioning, which shows when a mean falls on a rounding boundary;
    decimals add up exactly, whatever the row order."""
    return value.try_cast("decimal(30,12)")


def mean_of(total: Column, count: Column) -> Column:
    return F.try_divide(total.cast("double"), count.cast("double"))


def exact_mean(value: Column) -> Column:
    """Average of the finite values as an aggregate, independent of row order."""
    return mean_of(F.sum(exact(value)), F.count(exact(value)))
