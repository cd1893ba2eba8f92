"""Compare a query with its checking SQL, independent of row order."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(([_cell(row[i]) for i in order] for row in rows), key=repr), [names[i] for i in order]


def difference(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when both give the same rows, else a short description."""
    ours, our_names = _rows(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    theirs, their_names = _rows([d[0] for d in result.description], result.fetchall())
    if our_names != their_names:
        return f"columns {our_names} != {their_names}"
    if len(ours) != len(theirs):
        return f"{len(ours)} rows != {len(theirs)}"
    wrong = [(a, b) for a, b in zip(ours, theirs) if a != b or list(map(type, a)) != list(map(type, b))]
    if wrong:
        return f"{len(wrong)} of {len(ours)} rows differ on {our_names}, first {wrong[0]}"
    return None if ours else "no rows"
