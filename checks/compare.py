"""Run a query and its reference SQL side by side on one scale factor."""

from __future__ import annotations

import datetime
import decimal
import glob
import os
from collections import Counter

import duckdb
from pyspark.sql import SparkSession


def duckdb_tables(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set TimeZone='UTC'")
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return int(value) if value == value.to_integral_value() else float(value)
    if isinstance(value, float) and value.is_integer():
        return int(value)
    if isinstance(value, (datetime.datetime, datetime.date)):
        return str(value)
    return value


def _rows(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def compare(spark: SparkSession, query, sql: str, sf_dir: str) -> str | None:
    """None when both give the same rows, otherwise what differs."""
    left = query(spark, sf_dir)
    con = duckdb_tables(sf_dir)
    try:
        result = con.execute(sql)
        names = [d[0] for d in result.description]
        if sorted(names) != sorted(left.columns):
            return f"columns {sorted(left.columns)} vs {sorted(names)}"
        expected = _rows(names, result.fetchall())
    finally:
        con.close()
    actual = _rows(left.columns, [tuple(r) for r in left.collect()])
    if actual == expected:
        return None
    extra, missing = list((actual - expected).items())[:2], list((expected - actual).items())[:2]
    return f"{sum(actual.values())} vs {sum(expected.values())} rows; only ours {extra}; only expected {missing}"
