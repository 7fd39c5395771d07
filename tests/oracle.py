"""Runs a query and its DuckDB SQL on the same files and compares rows, independent of order."""

from __future__ import annotations

import math
from decimal import Decimal

import duckdb

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def _cell(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    return value


def _sorted(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    table = [tuple(_cell(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(table, key=lambda r: [(v is None, str(type(v)), v) for v in r])


def spark_rows(df):
    return _sorted(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(con, sql):
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    return _sorted(names, cursor.fetchall())


def difference(df, con, sql) -> str | None:
    """None when equal, else a short description."""
    (sc, sr), (dc, dr) = spark_rows(df), duck_rows(con, sql)
    if sc != dc:
        return f"columns {sc} != {dc}"
    if len(sr) != len(dr):
        return f"rows {len(sr)} != {len(dr)}"
    bad = [(a, b) for a, b in zip(sr, dr) if a != b]
    kinds = [(type(a).__name__, type(b).__name__) for ra, rb in zip(sr, dr) for a, b in zip(ra, rb) if type(a) is not type(b)]
    if bad:
        return f"{len(bad)} of {len(sr)} rows differ, e.g. {sc} spark {bad[0][0]} duckdb {bad[0][1]}"
    return f"types differ: {sorted(set(kinds))}" if kinds else None
