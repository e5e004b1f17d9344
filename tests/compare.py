"""Order-insensitive comparison of a Spark result with DuckDB SQL over the same tables."""

from __future__ import annotations

import math
import os
from collections import Counter

import duckdb


def duckdb_views(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in sorted(os.listdir(sf_dir)):
        if name.endswith(".parquet"):
            con.execute(f"CREATE VIEW {name[:-8]} AS SELECT * FROM '{sf_dir}/{name}'")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.12g}") + 0.0
    return value


def _multiset(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return Counter(tuple(_cell(row[i]) for i in order) for row in rows)


def differences(spark_df, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    result = con.execute(sql)
    expected_columns = [d[0] for d in result.description]
    expected = _multiset(expected_columns, result.fetchall())
    actual = _multiset(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    found = []
    if sorted(expected_columns) != sorted(spark_df.columns):
        found.append(f"columns {sorted(spark_df.columns)} != {sorted(expected_columns)}")
    if actual != expected:
        extra, missing = actual - expected, expected - actual
        found.append(
            f"{sum(actual.values())} rows != {sum(expected.values())}; "
            f"only Spark {list(extra)[:2]}; only SQL {list(missing)[:2]}"
        )
    return found
