"""Compare a Spark result with DuckDB's, value by value, in any row order."""

from __future__ import annotations

import datetime
import decimal
from collections import Counter

import duckdb

from relocate.plans.inputs import BASE


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in BASE:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def kind(value) -> str:
    if isinstance(value, bool):
        return "bool"
    if isinstance(value, int):
        return "int"
    if isinstance(value, (float, decimal.Decimal)):
        return "float"
    return type(value).__name__


def plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def differences(df, con, sql: str) -> list[str]:
    names = sorted(df.columns)
    rows = df.select(*names).collect()
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    if sorted(columns) != names:
        return [f"columns {names} and {sorted(columns)}"]
    places = [columns.index(n) for n in names]
    expected = [[r[i] for i in places] for r in result.fetchall()]
    notes = []
    if len(rows) != len(expected):
        notes.append(f"rows {len(rows)} and {len(expected)}")
    for i, name in enumerate(names):
        ours = {kind(r[i]) for r in rows if r[i] is not None}
        theirs = {kind(r[i]) for r in expected if r[i] is not None}
        if ours != theirs:
            notes.append(f"types of {name}: {ours} and {theirs}")
    left = Counter(tuple(plain(v) for v in r) for r in rows)
    right = Counter(tuple(plain(v) for v in r) for r in expected)
    for row in list((left - right).items())[:2]:
        notes.append(f"only Spark: {row}")
    for row in list((right - left).items())[:2]:
        notes.append(f"only SQL: {row}")
    return notes
