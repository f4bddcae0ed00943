"""Comparison of a query with its SQL twin: columns, row count and every value."""

from __future__ import annotations

import math
from collections import Counter

import duckdb
from pyspark.sql import SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _bag(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def plain(v):
        if isinstance(v, float) and math.isnan(v):
            return "nan"
        return v + 0.0 if isinstance(v, float) else v  # -0.0 equals 0.0

    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def differences(spark: SparkSession, query, sql: str, sf_dir: str,
                con: duckdb.DuckDBPyConnection) -> list[str]:
    df = query(spark, sf_dir)
    answer = con.execute(sql)
    columns = [d[0] for d in answer.description]
    if sorted(columns) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} against {sorted(columns)}"]
    expected, actual = _bag(columns, answer.fetchall()), _bag(df.columns, df.collect())
    found = []
    if expected.total() != actual.total():
        found.append(f"{actual.total()} rows against {expected.total()}")
    found += [f"only in Spark: {row}" for row in list((actual - expected))[:2]]
    found += [f"only in SQL:   {row}" for row in list((expected - actual))[:2]]
    return found
