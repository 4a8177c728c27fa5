"""Landed bars with the lines that name no bar kept apart: file, text and reason instead of a count.

A line is rejected if it has too few or too many fields, no ticker, or no readable date, in this order. Other
unreadable fields become NULL, as in `csv_files.read_bars`, and are left to the checks. Every line that is not
empty is either accepted or rejected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from marketlake import schemas
from marketlake.functions.casting import parse_field
from marketlake.functions.symbols import canonical_symbol
from marketlake.sources.csv_files import bars_path

MALFORMED, NO_TICKER, BAD_DATE = "malformed line", "no ticker", "unreadable date"
_BROKEN = "__broken"


def checked_bars(spark: SparkSession, root: str, ds: str | None = None) -> DataFrame:
    """The typed bars of a landed file with `file`, `line` and `reason`; accepted lines have no reason."""
    # a line is only malformed by all its fields, so none may be pruned
    rows = (
        spark.read.schema(schemas.as_text(schemas.STAGING).add(_BROKEN, "string"))
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "PERMISSIVE")
        .option("columnPruning", False)
        .option("columnNameOfCorruptRecord", _BROKEN)
        .csv(bars_path(root, ds))
    )
    fields = {f.name: parse_field(F.col(f.name), f.dataType) for f in schemas.STAGING}
    fields["ticker"] = canonical_symbol(F.col("ticker"))
    reason = (
        F.when(F.col(_BROKEN).isNotNull(), MALFORMED)
        .when(fields["ticker"].isNull(), NO_TICKER)
        .when(fields["snapshot_date"].isNull(), BAD_DATE)
    )
    line = F.coalesce(_BROKEN, F.to_csv(F.struct(*schemas.STAGING.fieldNames())))
    return rows.select(
        *(c.alias(n) for n, c in fields.items()), F.col("_metadata.file_path").alias("file"), line.alias("line"), reason.alias("reason")
    )


def accepted(checked: DataFrame) -> DataFrame:
    return checked.where(F.col("reason").isNull()).drop("file", "line", "reason")


def rejected(checked: DataFrame) -> DataFrame:
    return checked.where(F.col("reason").isNotNull()).select("file", "line", "reason")
