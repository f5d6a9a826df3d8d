"""Compares queries with their SQL in DuckDB: rows, columns and values."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings harvest_records url_entities datasets atom_items keyword_sets thredds_nodes descriptions relationships labels providers publishers containers".split()


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    c = duckdb.connect()
    c.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        p = Path(sf, f"{t}.parquet")
        if p.exists():
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{p / '*.parquet' if p.is_dir() else p}'")
    return c


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, int):
        return float(v) if abs(v) < 2**53 else v
    if isinstance(v, (list, tuple)) or hasattr(v, "tolist"):
        return tuple(plain(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, plain(x)) for k, x in v.items()))
    return str(v)


def rows(names, data) -> list:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in data), key=repr)


def differences(spark, sf: str, query, sql: str) -> str:
    """Empty if both give the same columns and rows, else what differs."""
    df = query(spark, sf)
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    cur = connect(sf).execute(sql)
    names = [d[0] for d in cur.description]
    want = rows(names, cur.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} and {sorted(names)}"
    if got == want:
        return ""
    a, b = set(got), set(want)
    return f"{len(got)} and {len(want)} rows; only in Spark {sorted(a - b, key=repr)[:3]}; only in SQL {sorted(b - a, key=repr)[:3]}"
