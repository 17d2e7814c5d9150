"""Compare a Spark result with an SQL result: same columns, same rows, exact values."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = """region nation customer supplier part orders lineitem events documents embeddings
pages benchmark labels conversations""".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        path = Path(sf_dir) / f"{table}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{path}')")
    return con


def _value(v):
    return repr(float(v)) if isinstance(v, float) and not math.isnan(v) else repr(v)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_value(r[i]) for i in order) for r in rows)


def difference(df, con, sql: str) -> str | None:
    """None if equal, else what differs first."""
    got = df.collect()
    want = con.execute(sql)
    columns = [d[0] for d in want.description]
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    a, b = _rows(df.columns, got), _rows(columns, want.fetchall())
    if len(a) != len(b):
        return f"{len(a)} rows != {len(b)} rows"
    for x, y in zip(a, b):
        if x != y:
            return f"{x} != {y}"
    return None
