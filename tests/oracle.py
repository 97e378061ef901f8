"""Compare a query with its SQL in DuckDB, rows in any order."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def connection(sf_dir: str):
    c = duckdb.connect()
    for p in glob.glob(f"{sf_dir}/*.parquet"):
        src = f"{p}/*.parquet" if os.path.isdir(p) else p
        c.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM read_parquet('{src}')")
    c.execute("SET TimeZone='UTC'")
    return c


def _plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, (list, tuple)):
        return tuple(map(_plain, v))
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def compare(df, sql: str, con) -> None:
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    rel = con.execute(sql)
    cols = [x[0] for x in rel.description]
    want = rows_of(cols, rel.fetchall())
    assert sorted(df.columns) == sorted(cols), (df.columns, cols)
    assert len(got) == len(want), (len(got), len(want))
    bad = [(a, b) for a, b in zip(got, want, strict=True) if a != b]
    assert not bad, bad[:3]
