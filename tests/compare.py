"""Order-insensitive comparison of a Spark result with an SQL result."""

from __future__ import annotations

import datetime as dt
import math
from pathlib import Path

import duckdb

SPARK_KINDS = {
    "string": "text", "double": "float", "bigint": "long", "int": "int", "boolean": "bool",
    "date": "date", "timestamp_ntz": "timestamp", "array<double>": "floats",
}
DUCK_KINDS = {
    "VARCHAR": "text", "DOUBLE": "float", "BIGINT": "long", "INTEGER": "int", "BOOLEAN": "bool",
    "DATE": "date", "TIMESTAMP": "timestamp", "DOUBLE[]": "floats",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, (list, tuple)):
        return [_plain(v) for v in value]
    if isinstance(value, (dt.date, dt.datetime)):
        return value.isoformat()
    return value


def _rows(names: list[str], rows) -> list[str]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(repr([_plain(row[i]) for i in order]) for row in rows)


def assert_same(df, con, sql: str) -> int:
    result = con.execute(sql)
    expected_kinds = {c[0]: DUCK_KINDS[str(c[1])] for c in result.description}
    expected = _rows([c[0] for c in result.description], result.fetchall())
    assert {name: SPARK_KINDS[kind] for name, kind in df.dtypes} == expected_kinds
    actual = _rows(df.columns, df.collect())
    assert len(actual) == len(expected), f"{len(actual)} rows, expected {len(expected)}"
    wrong = [(a, e) for a, e in zip(actual, expected) if a != e]
    assert not wrong, f"{len(wrong)} rows differ, e.g. {wrong[:3]}"
    return len(actual)
