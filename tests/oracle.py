"""Comparison of a query's rows with DuckDB's, without order, columns by name."""

from __future__ import annotations

import datetime
import decimal
from collections import Counter
from pathlib import Path

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str):
    c = duckdb.connect()
    for t in TABLES:
        p = Path(sf_dir, f"{t}.parquet")
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}{'/*' if p.is_dir() else ''}')")
    return c


def norm(v):
    if isinstance(v, float):
        return repr(round(v, 6))
    if isinstance(v, decimal.Decimal):
        return repr(round(float(v), 6))
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return str(v)


def bag(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(norm(r[i]) for i in order) for r in rows)


def compare(spark, sf_dir: str, query, sql: str) -> str:
    """What differs; empty if nothing does."""
    df = query(spark, sf_dir)
    got = bag(df.columns, df.collect())
    cursor = connect(sf_dir).execute(sql)
    names = [d[0] for d in cursor.description]
    want = bag(names, cursor.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} and {sorted(names)}"
    if got != want:
        return f"{sum(got.values())} and {sum(want.values())} rows; only here {list((got - want).items())[:3]}; only there {list((want - got).items())[:3]}"
    return ""
