"""Lists taken out of HTML pages held in a table (page_id, html)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

LIST_LINK = r'<li><a href="[^"]*">([^<]*)</a></li>'


def list_items(pages: DataFrame) -> DataFrame:
    """Distinct linked list entries of each page. Distinct within the row: no shuffle."""
    found = F.regexp_extract_all("html", F.lit(LIST_LINK), F.lit(1))
    return pages.select("page_id", F.explode(F.array_distinct(found)).alias("item"))


def _inner(html: Column, tag: str) -> Column:
    return F.regexp_extract_all(html, F.lit(rf"(?is)<{tag}\b[^>]*>(.*?)</{tag}\s*>"), F.lit(1))


def _cells(row: Column) -> Column:
    cells = F.regexp_extract_all(row, F.lit(r"(?is)<t[hd]\b[^>]*>(.*?)</t[hd]\s*>"), F.lit(1))
    return F.transform(cells, lambda c: F.regexp_replace(F.regexp_replace(c, "<[^>]*>", ""), r"^\s+|\s+$", ""))


def first_table_column(pages: DataFrame, header: str) -> DataFrame:
    """Values under ``header`` in the first table of each page, one row per table row.

    Pages without a table, or whose first table lacks the column, give no rows.
    """
    table = F.get(_inner(F.col("html"), "table"), F.lit(0))
    grid = pages.select("page_id", F.transform(_inner(table, "tr"), _cells).alias("grid"))
    at = grid.select(
        "page_id", "grid", F.array_position(F.get("grid", F.lit(0)), header).cast("int").alias("at")
    ).where(F.col("at") > 0)
    body = F.slice("grid", F.lit(2), F.greatest(F.size("grid") - 1, F.lit(0)))
    return (
        at.select("page_id", "at", F.explode(body).alias("cells"))
        .select("page_id", F.get("cells", F.col("at") - 1).alias("value"))
        .where(F.col("value").isNotNull())
    )
