"""Compares a Spark result with the second engine's result, row by row."""

from __future__ import annotations

import datetime as dt
import decimal
import glob
import math
import os
from collections import Counter

import duckdb
from pyspark.sql import DataFrame


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"create view {name} as select * from '{path}'")
    return con


def _plain(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 9)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 9)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_plain(x) for x in v)
    return v


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(r[i]) for i in order) for r in rows)


# Column type classes that the two engines must share.
def _kind(text: str) -> str:
    text = text.lower()
    for prefix, kind in (
        ("decimal", "decimal"), ("timestamp", "timestamp"), ("varchar", "string"),
        ("hugeint", "hugeint"), ("integer", "int"), ("array", "list"),
    ):
        if text.startswith(prefix):
            return kind
    return "list" if text.endswith("[]") else text


def differences(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Empty when names, types and the multiset of rows agree."""
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    theirs = cur.fetchall()
    types = {r[0]: r[1] for r in con.execute(f"describe {sql}").fetchall()}
    mine = [tuple(r) for r in df.collect()]
    problems = []
    if sorted(df.columns) != sorted(names):
        return [f"columns {sorted(df.columns)} against {sorted(names)}"]
    for name, kind in df.dtypes:
        if _kind(kind) != _kind(types[name]):
            problems.append(f"type of {name}: {kind} against {types[name]}")
    a, b = _rows(df.columns, mine), _rows(names, theirs)
    if a != b:
        problems.append(
            f"rows {sum(a.values())} against {sum(b.values())}; "
            f"only ours {list((a - b).items())[:3]}; only theirs {list((b - a).items())[:3]}"
        )
    return problems
