"""Runs a named query and its SQL over the same tables and compares the rows."""

from __future__ import annotations

import datetime as dt
import math
import os
from collections import Counter

import duckdb

SAMPLE_DIR = os.environ.get("SAMPLE_DIR", "/root/testdata/sf0.01")


def connect(sf_dir: str = SAMPLE_DIR) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(os.listdir(sf_dir)):
        name = file.removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{file}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, dt.date):
        return value.isoformat()
    return value


def _rows(table) -> Counter:
    names = sorted(table.column_names)
    columns = [table.column(n).to_pylist() for n in names]
    return Counter(tuple(_plain(x) for x in row) for row in zip(*columns, strict=True))


def _types(table) -> dict[str, str]:
    return {f.name: str(f.type).replace("large_", "") for f in table.schema}


def difference(con, spark_table, sql: str) -> str | None:
    """None when names, types and rows agree; else a short account of what differs."""
    theirs = con.execute(sql).to_arrow_table()
    if _types(spark_table) != _types(theirs):
        only = set(_types(spark_table).items()) ^ set(_types(theirs).items())
        return f"types differ: {sorted(only)}"
    a, b = _rows(spark_table), _rows(theirs)
    if a != b:
        return (
            f"{sum(a.values())} rows against {sum(b.values())}; "
            f"only here {list((a - b).items())[:3]}; only in SQL {list((b - a).items())[:3]}"
        )
    return None
