"""Comparison of a query's rows with those of its SQL in DuckDB."""

from __future__ import annotations

import math
import os

import duckdb


def sql_rows(sql: str, folder: str) -> tuple[list[str], list[tuple]]:
    con = duckdb.connect()
    for name in os.listdir(folder):
        path = f"{folder}/{name}"
        con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    got = con.execute(sql)
    return [c[0] for c in got.description], got.fetchall()


def plain(x):
    if isinstance(x, float):
        return None if math.isnan(x) else round(x, 9)
    return x


def as_bag(columns: list[str], rows: list) -> list[str]:
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return sorted(repr(tuple(plain(r[k]) for k in order)) for r in rows)


def assert_same(df, sql: str, folder: str) -> None:
    names, rows = sql_rows(sql, folder)
    assert sorted(df.columns) == sorted(names)
    mine = as_bag(df.columns, [tuple(r) for r in df.collect()])
    assert mine == as_bag(names, rows)
