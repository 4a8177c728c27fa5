"""Market-capitalisation classes."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from marketlake.functions.casting import finite

# Class label and the amount that must be exceeded to belong to it.
CLASS_FLOORS = [
    ("Mega Cap", 200e9),
    ("Large Cap", 10e9),
    ("Mid Cap", 2e9),
    ("Small Cap", 250e6),
]
SMALLEST_CLASS = "Micro Cap"
UNKNOWN_CLASS = "Not Provided"


def market_cap_class(market_cap: Column) -> Column:
    """Label of the class; missing, non-finite and 0 count as unknown, negatives as the smallest."""
    market_cap = finite(market_cap)
    label = F.when(market_cap.isNull() | (market_cap == 0), UNKNOWN_CLASS)
    for name, floor in CLASS_FLOORS:
        label = label.when(market_cap > floor, name)
    return label.otherwise(SMALLEST_CLASS)
