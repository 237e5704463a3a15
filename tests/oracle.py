"""Run a registered query and its SQL on the same files and compare the rows."""

from __future__ import annotations

import datetime
import decimal
import math
from pathlib import Path

import duckdb


def connect(folder: str):
    con = duckdb.connect()
    for path in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, (float, decimal.Decimal)):
        value = float(value)
        return "nan" if math.isnan(value) else value
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return [plain(v) for v in value]
    return value


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(([plain(r[i]) for i in order] for r in data), key=repr)


def compare(df, con, sql: str) -> None:
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    expected = rows(columns, cursor.fetchall())
    assert sorted(df.columns) == sorted(columns)
    actual = rows(df.columns, [tuple(r) for r in df.collect()])
    assert len(actual) == len(expected), f"{len(actual)} rows, expected {len(expected)}"
    for got, want in zip(actual, expected):
        assert got == want, f"\n got {str(got)[:600]}\nwant {str(want)[:600]}"
