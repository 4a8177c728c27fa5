"""Table schemas of the lake, one explicit StructType per table."""

from __future__ import annotations

from pyspark.sql import types as T


TYPES = {
    "string": T.StringType(),
    "double": T.DoubleType(),
    "bigint": T.LongType(),
    "date": T.DateType(),
    "timestamp_ntz": T.TimestampNTZType(),
    "array<double>": T.ArrayType(T.DoubleType()),
}


def _schema(columns: str) -> T.StructType:
    """StructType out of 'name type, ...'; needs no session, unlike Spark's own parser."""
    pairs = (column.split() for column in columns.split(","))
    return T.StructType([T.StructField(name, TYPES[kind]) for name, kind in pairs])


STAGING = _schema(
    "ticker string, snapshot_date date, open double, high double, low double,"
    " close double, volume bigint"
)

FACT = _schema(
    "ticker string, open_price double, high_price double, low_price double,"
    " close_price double, volume bigint, trade_date date"
)

CUMULATIVE = _schema("ticker string, price_history array<double>, last_updated date")

DIM_DAILY = _schema(
    "ticker string, price_history array<double>, latest_price double,"
    " historic_low double, historic_high double, last_updated date"
)

DETAILS = _schema(
    "ticker string, company_name string, sector string, industry string,"
    " market_cap double, market_cap_description string, exchange string, country string"
)

CURRENT_DAY = _schema(
    "ticker string, trade_date date, last_price double, open_price double,"
    " high_price double, low_price double, volume bigint, last_updated_ts timestamp_ntz"
)

METRICS = _schema(
    "ticker string, close_price_last_day double, close_price_avg_last_90_days double,"
    " close_price_avg_last_365_days double, current_price double,"
    " m_price_change_last_day double, m_price_change_last_day_pct double,"
    " m_price_change_last_90_days double, m_price_change_last_90_days_pct double,"
    " m_price_change_last_365_days double, m_price_change_last_365_days_pct double,"
    " market_cap_description string, last_updated_datetime timestamp_ntz"
)

# Table name in the lake -> (schema, partition columns).
TABLES = {
    "raw.staging_daily_stock_price": (STAGING, ("snapshot_date",)),
    "stg.fact_daily_stock_price": (FACT, ("trade_date",)),
    "marts.dim_ticker_details": (DETAILS, ()),
}

# Marts that are replaced as a whole, with a ledger of what they were made of: versions behind a view.
MARTS = {"marts.dim_daily_stock_price": DIM_DAILY}

# Views: name -> (mart that they are a projection of, columns).
PROJECTIONS = {"marts.cumulative_stock_price": ("marts.dim_daily_stock_price", CUMULATIVE)}

# Tables that micro-batches rewrite: kept as snapshots and served through a view.
LIVE_TABLES = {
    "marts.current_day_stock_price": CURRENT_DAY,
    "marts.current_day_metrics": METRICS,
}


def as_text(schema: T.StructType) -> T.StructType:
    """The same columns, all read as strings (how CSV files are scanned)."""
    return T.StructType([T.StructField(f.name, T.StringType()) for f in schema])


def columns_ddl(schema: T.StructType) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema)
