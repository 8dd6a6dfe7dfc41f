"""Run a registered query and its SQL on the same folder and compare rows exactly."""

from __future__ import annotations

import datetime
import decimal
import math
from collections import Counter
from functools import lru_cache

import duckdb

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations")


@lru_cache(maxsize=4)
def connection(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _value(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return 0.0 if v == 0 else v
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, datetime.datetime):
        return v.isoformat()
    if isinstance(v, datetime.date):
        return v.isoformat()
    return v


def rows(columns, data) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_value(r[i]) for i in order) for r in data)


def differences(spark_df, sql: str, folder: str) -> str | None:
    """None when both sides are equal, else what differs."""
    cursor = connection(folder).execute(sql)
    expected_columns = [c[0] for c in cursor.description]
    expected = rows(expected_columns, cursor.fetchall())
    if sorted(expected_columns) != sorted(spark_df.columns):
        return f"columns: spark {sorted(spark_df.columns)} sql {sorted(expected_columns)}"
    actual = rows(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if actual == expected:
        return None
    extra, missing = list((actual - expected).items())[:3], list((expected - actual).items())[:3]
    return (f"rows: spark {sum(actual.values())} sql {sum(expected.values())}; columns {sorted(spark_df.columns)}; "
            f"only spark {extra}; only sql {missing}")
