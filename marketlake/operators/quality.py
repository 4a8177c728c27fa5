"""Data-quality checks. Each returns rows; ``require`` turns a failed one into an error."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from marketlake.functions.times import micros_text


def null_checks(df: DataFrame, checks: dict[str, str]) -> DataFrame:
    """One row of booleans, ``{output name: column}``; all columns in a single pass."""
    return df.agg(*((F.count_if(F.col(c).isNull()) == 0).alias(name) for name, c in checks.items()))


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One labelled count per table; each scans no columns it does not need."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("cnt")).select(F.lit(name).alias("tbl"), "cnt")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def dim_matches_fact(dim: DataFrame, fact: DataFrame) -> DataFrame:
    tickers = fact.agg(F.count_distinct("ticker")).scalar()
    counted = dim.agg(F.count(F.lit(1)).alias("dim_rows")).withColumn("tickers", tickers)
    return counted.withColumn("matches", F.col("dim_rows") == F.col("tickers"))


def current_day_sanity(
    current_day: DataFrame, day: Column | None = None, min_rows: int = 400
) -> DataFrame:
    """Rows and newest update of one date (default: the table's last), and a verdict."""
    last = current_day.agg(F.max("trade_date")).scalar() if day is None else day
    return (
        current_day.where(F.col("trade_date") == last)
        .agg(F.count(F.lit(1)).alias("n"), F.max("last_updated_ts").alias("latest"))
        .select("n", micros_text(F.col("latest")).alias("latest_ts"), (F.col("n") >= min_rows).alias("passed"))
    )


def load_profile(staging: DataFrame) -> DataFrame:
    return staging.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.min("snapshot_date").alias("first_date"),
        F.max("snapshot_date").alias("last_date"),
        F.count_distinct("ticker").alias("tickers"),
    )


def preview(df: DataFrame, rows: int = 10) -> DataFrame:
    """Some rows to look at, in no particular order."""
    return df.limit(rows)


def quality_report(fact: DataFrame, dim: DataFrame) -> DataFrame:
    """All batch checks as rows (check_name, passed, observed, expected): the fact is read
    once for the null checks and the distinct tickers, the dimension once for its rows."""
    required = ("ticker", "close_price", "trade_date")
    facts = fact.agg(
        *(F.count_if(F.col(c).isNull()).alias(c) for c in required),
        F.count_distinct("ticker").alias("tickers"),
    )
    wide = facts.withColumn("dim_rows", dim.agg(F.count(F.lit(1))).scalar())
    nulls = [
        F.struct(F.lit(f"{c} not null").alias("check_name"), F.col(c).alias("observed"), F.lit(0).cast("bigint").alias("expected"))
        for c in required
    ]
    matches = F.struct(
        F.lit("dim rows match tickers").alias("check_name"), F.col("dim_rows").alias("observed"), F.col("tickers").alias("expected")
    )
    return wide.select(F.inline(F.array(*nulls, matches))).select(
        "check_name", (F.col("observed") == F.col("expected")).alias("passed"), "observed", "expected"
    )


def require(verdicts: DataFrame, passed: str = "passed") -> DataFrame:
    """Raise when a verdict row failed. Only the failed rows of a check travel."""
    wrong = verdicts.where(~F.col(passed))
    failed = wrong.take(10)
    if failed:
        shown = [row.asDict() for row in failed]
        raise ValueError(f"{wrong.count()} data-quality checks failed, among them: {shown}")
    return verdicts
