"""Runs a registered query and its SQL and compares all values."""

from __future__ import annotations

import datetime as dt
import math
import os

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        if os.path.exists(f"{sf_dir}/{table}.parquet"):
            con.execute(f"CREATE VIEW {table} AS FROM '{sf_dir}/{table}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, (dt.datetime, dt.date)):
        return value.isoformat()
    return repr(value)


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    names = sorted(df.columns)
    return names, sorted(tuple(plain(r[n]) for n in names) for r in df.collect())


def duck_rows(con, sql: str) -> tuple[list[str], list[tuple]]:
    cur = con.execute(sql)
    columns = [d[0] for d in cur.description]
    names = sorted(columns)
    at = [columns.index(n) for n in names]
    return names, sorted(tuple(plain(r[i]) for i in at) for r in cur.fetchall())


def difference(df, con, sql: str) -> str | None:
    """None when equal, else what differs."""
    left_names, left = spark_rows(df)
    right_names, right = duck_rows(con, sql)
    if left_names != right_names:
        return f"columns {set(left_names) ^ set(right_names)}"
    if len(left) != len(right):
        return f"{len(left)} rows against {len(right)}"
    for a, b in zip(left, right):
        if a != b:
            bad = [(n, x, y) for n, x, y in zip(left_names, a, b) if x != y]
            return f"values {bad[:4]}"
    return None
