"""Compare a Spark result with the rows DuckDB finds for the same tables."""

from __future__ import annotations

import datetime
import math
from collections import Counter
from decimal import Decimal

import duckdb

from evenkeel.plans.warehouse import GIVEN


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in GIVEN:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, (int, float, Decimal)):
        number = float(value)
        return "nan" if math.isnan(number) else float(f"{number:.12g}")
    if isinstance(value, (datetime.date, datetime.datetime)):
        return str(value)
    return value


def multiset(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in rows)


def differences(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    if sorted(names) != sorted(df.columns):
        return f"columns differ: {sorted(df.columns)} against {sorted(names)}"
    expected, actual = multiset(names, found.fetchall()), multiset(df.columns, df.collect())
    if expected == actual:
        return None
    missing, extra = list((expected - actual).items())[:3], list((actual - expected).items())[:3]
    return f"{sum(expected.values())} rows expected, {sum(actual.values())} found; missing {missing}; extra {extra}"
