"""Run queries next to their SQL: python -m checks.verify [sf_dir] [name prefix ...]"""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb
import pandas as pd

from checks import ORACLE, QUERIES
from graticule.session import local_session


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def canonical(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        if str(df[c].dtype).startswith("datetime"):
            df[c] = df[c].astype("datetime64[us]")
        elif df[c].dtype == object:
            df[c] = df[c].where(df[c].notna(), None).astype(str)
    return df.sort_values(list(df.columns), ignore_index=True) if len(df.columns) else df


def difference(got: pd.DataFrame, want: pd.DataFrame) -> str | None:
    """None when both hold the same rows."""
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} != {sorted(want.columns)}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    a, b = canonical(got), canonical(want)
    for c in a.columns:
        if a[c].dtype.kind != b[c].dtype.kind and len(a) and not (a[c].isna().any() or b[c].isna().any()):
            return f"{c}: {a[c].dtype} != {b[c].dtype}"
        x, y = (a[c].astype(float), b[c].astype(float)) if a[c].dtype.kind in "iuf" else (a[c], b[c])
        same = (x == y) | (x.isna() & y.isna())
        if not same.all():
            i = same.idxmin()
            return f"{c}: {(~same).sum()} of {len(a)} differ, first {x[i]!r} != {y[i]!r}"
    return None


def main() -> int:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = tuple(sys.argv[2:])
    spark, con = local_session(), connect(sf)
    bad = 0
    for name, query in QUERIES.items():
        if wanted and not name.startswith(wanted):
            continue
        start = time.time()
        try:
            got = query(spark, sf).toPandas()
            took = time.time() - start
            if name not in ORACLE:
                print(f"rows  {name:36s} {took:6.2f}s {len(got)} rows")
                continue
            start = time.time()
            problem = difference(got, con.execute(ORACLE[name]).df())
            sql = time.time() - start
            print(f"{'ok   ' if problem is None else 'DIFF '} {name:36s} {took:6.2f}s sql {sql:5.2f}s {len(got)} rows {problem or ''}", flush=True)
            bad += problem is not None
        except Exception as e:
            bad += 1
            print(f"ERROR {name:36s} {str(e)[:600]}", flush=True)
    print("failed:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(min(main(), 1))
