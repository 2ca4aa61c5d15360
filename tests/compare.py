"""Run a query and its SQL side by side and compare the rows as multisets."""

from __future__ import annotations

import datetime
import decimal
import glob
import math
import os
from collections import Counter

import duckdb


def connect(sf_dir):
    conn = duckdb.connect()
    conn.execute("set timezone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        conn.execute(f"create view {name} as select * from '{path}'")
    return conn


def plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return float(f"{value:.9g}") + 0.0
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    if isinstance(value, list):
        return tuple(plain(v) for v in value)
    return value


def bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def differences(df, conn, sql):
    """None if both sides agree, else a short description."""
    result = conn.execute(sql)
    columns = [d[0] for d in result.description]
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(columns)}"
    theirs = bag(columns, result.fetchall())
    ours = bag(df.columns, [tuple(r) for r in df.collect()])
    if ours == theirs:
        return None
    return (
        f"{sum(ours.values())} rows against {sum(theirs.values())};"
        f" only ours {list((ours - theirs).items())[:2]},"
        f" only theirs {list((theirs - ours).items())[:2]}"
    )
