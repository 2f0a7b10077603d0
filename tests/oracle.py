"""Compare a registered query with its SQL on the same Parquet files."""

from __future__ import annotations

import decimal
import math

import duckdb

from auditloom.workload.binding import NAMES


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in NAMES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    return value


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    body = [tuple(_plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(body, key=lambda r: tuple((x is None, type(x).__name__, x) for x in r))


def sql_table(con, sql: str):
    result = con.execute(sql)
    return table([d[0] for d in result.description], result.fetchall())


def spark_table(df):
    return table(df.columns, [tuple(r) for r in df.collect()])


def differences(left, right, limit: int = 5) -> list[str]:
    if left[0] != right[0]:
        return [f"columns {left[0]} vs {right[0]}"]
    out = [] if len(left[1]) == len(right[1]) else [f"rows {len(left[1])} vs {len(right[1])}"]
    for a, b in zip(left[1], right[1]):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            out.append(f"{a} vs {b}")
        if len(out) >= limit:
            break
    return out
