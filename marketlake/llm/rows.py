"""Names and keys for rows of tables whose other columns may be called anything."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def unused(names: list[str], name: str) -> str:
    """A column name that no column begins with."""
    while any(n.startswith(name) for n in names):
        name = "_" + name
    return name


def row_key(doc_id: str, text: str) -> Column:
    """Rows of one id and one text are one."""
    return F.xxhash64(F.col(doc_id), F.coalesce(F.col(text), F.lit("")))
