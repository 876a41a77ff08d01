"""Holds a query against its DuckDB twin."""

import math
from pathlib import Path

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.sql("SET TimeZone='UTC'")
    for t in TABLES:
        p = Path(f"{sf_dir}/{t}.parquet")
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}{'/**/*.parquet' if p.is_dir() else ''}')")
    return con


def _cell(x):
    if x is None or isinstance(x, float) and math.isnan(x):
        return "null"
    if isinstance(x, float):
        return f"{x:.6g}" if x else "0"
    return str(x)


def compare(df, con, sql: str) -> str:
    """Empty if rows, columns and values agree, else what differs."""
    want = con.sql(sql)
    names = sorted(df.columns)
    if names != sorted(want.columns):
        return f"columns {names} and {sorted(want.columns)}"
    got = sorted(tuple(_cell(r[c]) for c in names) for r in df.collect())
    at = [want.columns.index(c) for c in names]
    exp = sorted(tuple(_cell(r[i]) for i in at) for r in want.fetchall())
    if len(got) != len(exp):
        return f"{len(got)} rows, not {len(exp)}"
    bad = [(g, e) for g, e in zip(got, exp, strict=True) if g != e]
    return f"{len(bad)} of {len(got)} rows differ, e.g. {bad[0]}" if bad else ""
