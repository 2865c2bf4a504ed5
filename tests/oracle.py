"""Runs a registered query and its SQL and compares the results."""

from __future__ import annotations

import math

import duckdb

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    return value


def _sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(r[i]) for i in order) for r in rows]
    return sorted(columns), sorted(plain, key=repr)


def spark_result(df):
    return _sorted_rows(df.columns, [tuple(r) for r in df.collect()])


def duck_result(con, sql):
    cursor = con.execute(sql)
    return _sorted_rows([d[0] for d in cursor.description], cursor.fetchall())


def difference(df, con, sql) -> str | None:
    """None when both give the same rows, else a short description."""
    columns, rows = spark_result(df)
    expected_columns, expected = duck_result(con, sql)
    if columns != expected_columns:
        return f"columns {columns} != {expected_columns}"
    if len(rows) != len(expected):
        return f"{len(rows)} rows != {len(expected)} rows"
    for got, want in zip(rows, expected):
        if got != want or [type(a) for a in got] != [type(b) for b in want]:
            return f"{columns}: {str(got)[:600]} != {str(want)[:600]}"
    return None
