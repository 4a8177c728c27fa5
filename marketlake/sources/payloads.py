"""JSON payloads of the price and company-information feeds."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from marketlake import schemas
from marketlake.functions.casting import finite
from marketlake.functions.market_cap import market_cap_class
from marketlake.functions.symbols import canonical_symbol
from marketlake.functions.times import parse_iso

BARS_SCHEMA = "bars map<string, struct<c: double, t: string>>"
COMPANY_SCHEMA = (
    "symbol string, shortName string, sector string, industry string,"
    " marketCap double, exchange string, country string"
)


def explode_bars(docs: DataFrame, column: str = "payload") -> DataFrame:
    """One row per symbol of ``{"bars": {SYM: {"c": .., "t": ..}}}``.

    Documents without bars, with an empty map or that do not parse give no row;
    whole-number closes arrive as doubles.
    """
    bars = docs.select(F.from_json(column, BARS_SCHEMA)["bars"].alias("bars"))
    return bars.select(F.explode("bars").alias("symbol", "bar")).select(
        canonical_symbol(F.col("symbol")).alias("ticker"),
        finite(F.col("bar.c")).alias("current_price"),
        parse_iso(F.col("bar.t")).alias("last_updated_ts"),
    )


def flatten_company(docs: DataFrame, column: str = "payload") -> DataFrame:
    """Company-information documents -> details rows; absent strings become ''."""
    info = docs.select(F.from_json(column, COMPANY_SCHEMA).alias("i")).select("i.*")

    def text(name: str):
        return F.coalesce(F.col(name), F.lit(""))

    return info.select(
        canonical_symbol(F.col("symbol")).alias("ticker"),
        text("shortName").alias("company_name"),
        text("sector").alias("sector"),
        text("industry").alias("industry"),
        finite(F.col("marketCap")).alias("market_cap"),
        market_cap_class(F.col("marketCap")).alias("market_cap_description"),
        text("exchange").alias("exchange"),
        text("country").alias("country"),
    ).select(*schemas.DETAILS.fieldNames())
