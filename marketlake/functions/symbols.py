"""Ticker spelling: feeds write class shares as BRK-B, the lake stores BRK.B."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def canonical_symbol(symbol: Column) -> Column:
    return F.translate(symbol, "-", ".")


def feed_symbol(symbol: Column) -> Column:
    return F.translate(symbol, ".", "-")
