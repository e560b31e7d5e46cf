"""Compare a Spark result with the oracle's, column by column and row by row."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for f in glob.glob(f"{folder}/*.parquet"):
        con.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return con


def _norm(v):
    if v is None:
        return ""
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0 if v else 0.0)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return str(v)


_KIND = {
    "int": "int", "bigint": "int", "smallint": "int", "tinyint": "int", "integer": "int", "hugeint": "huge",
    "double": "float", "float": "float", "string": "text", "varchar": "text", "boolean": "bool", "timestamp": "ts", "timestamp_ntz": "ts",
}


def diff(df, con, sql: str) -> str:
    """Empty when equal, else a short description."""
    names = sorted(df.columns)
    rel = con.execute(sql)
    other = [d[0] for d in rel.description]
    if sorted(other) != names:
        return f"columns {names} vs {sorted(other)}"
    kinds = {d[0]: _KIND.get(str(d[1]).lower(), str(d[1]).lower()) for d in rel.description}
    mine = {n: _KIND.get(k, k) for n, k in df.dtypes}
    wrong = {n: (mine[n], kinds[n]) for n in names if mine[n] != kinds[n]}
    order = [other.index(n) for n in names]
    b = sorted(tuple(_norm(r[i]) for i in order) for r in rel.fetchall())
    a = sorted(tuple(_norm(r[n]) for n in names) for r in df.collect())
    if len(a) != len(b):
        extra = [x for x in a if x not in set(b)][:2], [x for x in b if x not in set(a)][:2]
        return f"rows {len(a)} vs {len(b)} {extra}"
    if a != b:
        sa, sb = set(a), set(b)
        return f"{len(sa - sb)} of {len(a)} rows differ: {sorted(sa - sb)[:2]} vs {sorted(sb - sa)[:2]}"
    return f"types {wrong}" if wrong else ""
