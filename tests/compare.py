"""Run queries against their SQL check in DuckDB and compare whole results."""

from __future__ import annotations

import glob
import math
import os
import time
from collections import Counter

import duckdb


LAST: dict[str, float] = {}


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[:-8]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(round(v, 9))
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return repr(v)


def compare(df, con, sql: str) -> str | None:
    """None when both agree, else a short description of the difference."""
    t0 = time.time()
    rows = df.collect()
    LAST["spark"] = time.time() - t0
    rel = con.execute(sql)
    cols = [d[0] for d in rel.description]
    if sorted(cols) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(cols)}"
    order = sorted(cols)
    pos = [cols.index(c) for c in order]
    want = Counter(tuple(_norm(r[i]) for i in pos) for r in rel.fetchall())
    got = Counter(tuple(_norm(r[c]) for c in order) for r in rows)
    if got == want:
        return None
    extra, missing = list((got - want).elements()), list((want - got).elements())
    return (
        f"{sum(got.values())} vs {sum(want.values())} rows; columns {order}\n"
        f"  spark only {len(extra)}: {sorted(extra, key=str)[:4]}\n  sql only {len(missing)}: {sorted(missing, key=str)[:4]}"
    )
