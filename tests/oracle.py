"""Runs a catalog query and its SQL on the same tables and compares the values."""

from __future__ import annotations

import datetime
import decimal
import glob
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"create view {name} as select * from '{path}'")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, float):
        return repr(round(value, 9) + 0.0) if value != int(value) else str(int(value))
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return "NULL" if value is None else str(value)


def table_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(spark, con, sf_dir, fn, sql) -> str | None:
    """None when equal, else a short description of the difference."""
    df = fn(spark, sf_dir)
    got_columns, got = table_of(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    want_columns, want = table_of([d[0] for d in result.description], result.fetchall())
    if got_columns != want_columns:
        return f"columns {got_columns} != {want_columns}"
    if got != want:
        extra = [r for r in got if r not in set(want)][:3]
        missing = [r for r in want if r not in set(got)][:3]
        return f"rows {len(got)} vs {len(want)}; only Spark: {extra}; only SQL: {missing}"
    return None
