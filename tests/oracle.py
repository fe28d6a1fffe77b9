"""Compares a Spark result with the result of its SQL on DuckDB."""

from __future__ import annotations

import glob
import math
import os
from collections import Counter

import duckdb

#: The smallest of the given tables.
SMALL = "/root/testdata/sf0.001"


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    return value


def rows(names, data) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_cell(row[i]) for i in order) for row in data)


def differences(spark_df, con, sql: str) -> list[str]:
    """Empty if column names, row counts and values agree."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    expected_rows = result.fetchall()
    if sorted(names) != sorted(spark_df.columns):
        return [f"columns {sorted(spark_df.columns)} != {sorted(names)}"]
    got, expected = rows(spark_df.columns, spark_df.collect()), rows(names, expected_rows)
    found = []
    if sum(got.values()) != sum(expected.values()):
        found.append(f"{sum(got.values())} rows != {sum(expected.values())}")
    if got != expected:
        found.append(f"only Spark: {list((got - expected).items())[:3]}; only SQL: {list((expected - got).items())[:3]}")
    return found
