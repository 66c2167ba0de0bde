"""Run a query and its SQL statement over the same tables and compare the rows."""

from __future__ import annotations

import datetime as dt
from collections import Counter

import duckdb
from pyspark.sql import DataFrame

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def plain(value):
    if isinstance(value, dt.datetime):
        return value.date()
    if isinstance(value, float):
        return round(value, 9)
    return value


def multiset(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def spark_rows(df: DataFrame) -> Counter:
    return multiset(df.columns, df.collect())


def sql_rows(con: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], Counter]:
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    return columns, multiset(columns, cursor.fetchall())


def difference(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when columns and rows agree, else what differs."""
    columns, expected = sql_rows(con, sql)
    if sorted(columns) != sorted(df.columns):
        return f"columns: only spark {set(df.columns) - set(columns)}, only sql {set(columns) - set(df.columns)}"
    got = spark_rows(df)
    if got != expected:
        extra, lacking = got - expected, expected - got
        names = sorted(columns)
        return (
            f"rows {sum(got.values())} vs {sum(expected.values())}; {names}; "
            f"only spark {list(extra)[:2]}; only sql {list(lacking)[:2]}"
        )
    return None
