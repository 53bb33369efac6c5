"""Side-by-side check of registered queries against DuckDB on the same parquet tables."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return float(f"{v:.9g}")
    if isinstance(v, decimal.Decimal):
        return ("decimal", str(v))
    if isinstance(v, (dt.date, dt.datetime)):
        return (type(v).__name__, str(v))
    return v


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_norm(r[i]) for i in order) for r in data]
    return sorted(columns), sorted(out, key=repr)


def compare(name, df, con, sql) -> str | None:
    """None when equal, else a description of the first difference."""
    got_cols, got = rows(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    want_cols, want = rows([d[0] for d in cur.description], cur.fetchall())
    if got_cols != want_cols:
        return f"{name}: columns {got_cols} != {want_cols}"
    if len(got) != len(want):
        return f"{name}: rows {len(got)} != {len(want)}"
    bad = [(g, w) for g, w in zip(got, want) if g != w or [type(x) for x in g] != [type(x) for x in w]]
    if bad:
        return f"{name}: {len(bad)} rows differ, first {bad[0]} {got_cols}"
    if not got:
        return f"{name}: both empty"
    return None


def default_dir() -> str:
    return os.environ.get("STRATA_SF_DIR", "/root/testdata/sf0.001")
