"""Runs a query and its SQL side by side and reports the first difference."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def second_engine(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        db.execute(f"create view {name} as select * from read_parquet('{path}')")
    return db


def _sortable(row):
    return tuple((v is None, str(type(v)), "" if v is None else v) for v in row)


def _close(a, b) -> bool:
    if isinstance(a, float) and isinstance(b, float):
        return math.isclose(a, b, rel_tol=0, abs_tol=1e-9)
    return a == b and type(a) is type(b)


def difference(df, db, sql: str) -> str | None:
    """None when both give the same columns and the same rows in any order."""
    columns = sorted(df.columns)
    ours = sorted((tuple(r) for r in df.select(*columns).collect()), key=_sortable)
    result = db.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != columns:
        return f"columns {columns} against {sorted(names)}"
    place = [names.index(c) for c in columns]
    theirs = sorted((tuple(r[i] for i in place) for r in result.fetchall()), key=_sortable)
    if len(ours) != len(theirs):
        return f"{len(ours)} rows against {len(theirs)}"
    for a, b in zip(ours, theirs):
        if not all(map(_close, a, b)):
            return f"{columns}: {str(a)[:300]} against {str(b)[:300]}"
    return None
