"""Wide price frames: one row per date, one column per (ticker, field).

Frames with some columns melt as data frames. Landed frames of any width melt as lines
(``read_lines``): the header is data there, a relation of symbols and the places of their
fields, so neither plan nor schema grows with the number of symbols.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from marketlake import schemas
from marketlake.functions.casting import finite
from marketlake.functions.rounding import rounded
from marketlake.functions.symbols import canonical_symbol
from marketlake.functions.times import wall_clock_to_utc
from marketlake.operators.cleaning import drop_incomplete

FIELDS = ("open", "high", "low", "close", "volume")


def symbols_in(df: DataFrame) -> list[str]:
    """Symbols with a full set of ``<symbol>_<Field>`` columns, in column order."""
    names = {c.lower() for c in df.columns}
    found = dict.fromkeys(c.rsplit("_", 1)[0] for c in df.columns if c.lower().endswith("_close"))
    return [s for s in found if all(f"{s.lower()}_{f}" in names for f in FIELDS)]


def _melt(df: DataFrame, keep: list[Column], places: int | None) -> DataFrame:
    """Wide -> one row per symbol, incomplete bars left out.

    Each input row expands in place: one array for each field, zipped and inlined, so there
    is no shuffle, unlike an unpivot that has to be grouped back into bars. Casts and rounding
    follow once per bar, and the plan stays as small for 500 symbols as for five.
    """
    lower = df.toDF(*(c.lower() for c in df.columns))
    symbols = symbols_in(df)

    def values(field: str) -> Column:
        return F.array(*(F.col(f"`{symbol.lower()}_{field}`").cast("double") for symbol in symbols))

    names = F.array(*map(F.lit, symbols)) if symbols else F.array().cast("array<string>")
    zipped = F.arrays_zip(names.alias("ticker"), *(values(f).alias(f) for f in FIELDS))
    return _bars(lower.select(*keep, F.inline(zipped)), places)


def _bars(rows: DataFrame, places: int | None) -> DataFrame:
    """Raw doubles by symbol -> complete, rounded bars under canonical symbols."""

    def price(field: str) -> Column:
        value = finite(F.col(field))
        return value if places is None else rounded(value, places)

    carried = [c for c in rows.columns if c not in ("ticker", *FIELDS)]
    return drop_incomplete(
        rows.select(
            *carried,
            canonical_symbol(F.col("ticker")).alias("ticker"),
            *(price(f).alias(f) for f in FIELDS[:-1]),
            finite(F.col("volume")).try_cast("bigint").alias("volume"),
        )
    )


def _melt_lines(lines: DataFrame, time: str, frame: tuple[str, ...], kind: str, places: int | None) -> DataFrame:
    """Lines of wide frames -> one row per symbol. Every line is split once; a frame's header
    says at which places a symbol has its fields, and each line reads just those.

    ``frame`` names the columns that tell frames apart. A frame's header line, whose first cell
    is ``time``, may stand in any of its files and may repeat; lines without a header are left out.
    """
    keys = list(frame) or ["_frame"]
    cells = lines.withColumn("_frame", F.lit(0)).select(*keys, F.split("value", ",").alias("cells"))
    heading = F.lower(F.trim(F.col("cells")[0])) == time.lower()
    names = cells.where(heading).groupBy(*keys).agg(F.min("cells").alias("cells"))
    named = names.select(*keys, F.posexplode("cells").alias("place", "name")).withColumn("name", F.trim("name"))
    field = F.lower(F.substring_index("name", "_", -1))
    symbol = F.expr("left(name, length(name) - length(substring_index(name, '_', -1)) - 1)")
    fields = [F.max(F.when(field == f, F.col("place") + 1)).alias(f) for f in FIELDS]
    complete = named.where(field.isin(*FIELDS)).groupBy(*keys, symbol.alias("symbol")).agg(*fields).na.drop(subset=list(FIELDS))
    header = complete.groupBy(*keys).agg(F.collect_list(F.struct("symbol", *FIELDS)).alias("symbols"))

    def cell(symbol: Column, field: str) -> Column:
        return F.try_element_at("cells", symbol[field])

    def traded(symbol: Column) -> Column:  # parsing empty cells would cost more than all others
        return F.trim(cell(symbol, "close")) != ""

    def bar(symbol: Column) -> Column:
        values = (F.nullif(F.trim(cell(symbol, f)), F.lit("")).try_cast("double").alias(f) for f in FIELDS)
        return F.struct(symbol["symbol"].alias("ticker"), *values)

    at = F.trim(F.col("cells")[0]).try_cast(kind).alias(time.lower())
    return _bars(cells.where(~heading).join(header, keys).select(*frame, at, F.inline(F.transform(F.filter("symbols", traded), bar))), places)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Landed wide frames as lines; partition folders become columns."""
    return spark.read.text(path)


def melt_bar_lines(lines: DataFrame, frame: tuple[str, ...] = (), places: int | None = 4) -> DataFrame:
    """Lines of daily frames (first column ``Date``) -> staging rows, with the columns of ``frame``."""
    rows = _melt_lines(lines, "Date", frame, "date", places).withColumnRenamed("date", "snapshot_date")
    return rows.where("snapshot_date IS NOT NULL").select(*frame, *schemas.STAGING.fieldNames())


def melt_intraday_lines(
    lines: DataFrame, zone: str | None = None, frame: tuple[str, ...] = (), places: int | None = 4
) -> DataFrame:
    """Lines of intraday frames (first column ``Datetime``, wall clock of ``zone``) -> current-day records."""
    rows = _melt_lines(lines, "Datetime", frame, "timestamp_ntz", places).where("datetime IS NOT NULL")
    local = F.col("datetime")
    rows = rows.select(
        "*", local.cast("date").alias("trade_date"), wall_clock_to_utc(local, zone).alias("last_updated_ts")
    ).withColumnsRenamed({"close": "last_price", **{f: f"{f}_price" for f in ("open", "high", "low")}})
    return rows.select(*frame, *schemas.CURRENT_DAY.fieldNames())


def melt_bars(df: DataFrame, keep: tuple[str, ...] = (), places: int | None = 4) -> DataFrame:
    """Daily frames (column ``Date``) -> staging rows; ``keep`` carries further columns."""
    date = F.col("date").cast("date").alias("snapshot_date")
    rows = _melt(df, [*map(F.col, keep), date], places)
    return rows.select(*keep, *schemas.STAGING.fieldNames())


def melt_intraday(
    df: DataFrame, zone: str | None = None, keep: tuple[str, ...] = (), places: int | None = 4
) -> DataFrame:
    """Intraday frames (column ``Datetime``, wall clock of ``zone``) -> current-day records.
    The trade date is the local one, the update time is UTC."""
    local = F.col("datetime").cast("timestamp_ntz")
    times = [
        local.cast("date").alias("trade_date"),
        wall_clock_to_utc(local, zone).alias("last_updated_ts"),
    ]
    rows = _melt(df, [*map(F.col, keep), *times], places).withColumnsRenamed(
        {"close": "last_price", **{f: f"{f}_price" for f in ("open", "high", "low")}}
    )
    return rows.select(*keep, *schemas.CURRENT_DAY.fieldNames())
