"""Compare a query with its SQL in DuckDB, as multisets of rows."""

from __future__ import annotations

import datetime as dt
import glob
import os
from collections import Counter

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"create view {name} as select * from '{path}'")
    return con


def _plain(v):
    if isinstance(v, float):
        return round(v, 9)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    if isinstance(v, (bytes, bytearray)):
        return bytes(v)
    if isinstance(v, (list, tuple)):
        return tuple(_plain(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _plain(x)) for k, x in v.items()))
    return v


def rows_of(columns, rows) -> tuple[list[str], Counter]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def difference(df, con, sql: str) -> str | None:
    """None if equal, else a short account of what differs."""
    rel = con.execute(sql)
    want_cols, want = rows_of([d[0] for d in rel.description], rel.fetchall())
    got_cols, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if want_cols != got_cols:
        return f"columns {got_cols} != {want_cols}"
    if want != got:
        return f"{sum(got.values())} rows, want {sum(want.values())}; extra {list((got - want))[:3]}; missing {list((want - got))[:3]}"
    if not want:
        return "no rows"
    return None
