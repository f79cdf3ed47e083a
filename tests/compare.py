"""Runs a registered query and its SQL on the same files and compares the rows."""

from __future__ import annotations

import glob
import os

import duckdb


def duck(folder: str):
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def _rows(columns: list[str], rows) -> list[str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr(tuple(r[i] for i in order)) for r in rows)


# A column's engine type must agree as well as its values.
KINDS = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def differences(df, con, sql: str) -> list[str]:
    """Empty when names, types and rows agree; else a few lines on what differs."""
    got = df.collect()
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    types = {d[0]: str(d[1]) for d in result.description}
    want = result.fetchall()
    if sorted(df.columns) != sorted(names):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    bad = [f"type of {c}: {t} != {types[c]}" for c, t in df.dtypes if KINDS.get(t) != types[c]]
    if bad:
        return bad
    left, right = _rows(df.columns, got), _rows(names, want)
    if left == right:
        return []
    a, b = set(left) - set(right), set(right) - set(left)
    out = [f"rows {len(left)} vs {len(right)}, only here {len(a)}, only there {len(b)}",
           str(sorted(names))]
    return out + sorted(a)[:2] + ["--"] + sorted(b)[:2]
