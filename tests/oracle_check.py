"""Compare every registered query with its DuckDB twin, as the driver does.

    python tests/oracle_check.py [sf_dir] [name ...]

Per query: row count, column names, and the multiset of rows after sorting columns by name
(doubles compared to 9 significant digits).
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return float(f"{v:.9g}")
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return v


def rows_of(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in records), key=repr)


def duck_connection(sf_dir):
    import duckdb
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def check(spark, sf_dir, names=None, verbose=True):
    import __spark_entry__ as E
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck_connection(sf_dir)
    results = {}
    for name in names or sorted(qs):
        t0 = time.time()
        df = qs[name](spark, sf_dir)
        cols = df.columns
        srows = rows_of(cols, [tuple(r) for r in df.collect()])
        ts = time.time() - t0
        if name not in sqls:
            results[name] = ("rows-only", len(srows), ts)
            if verbose:
                print(f"{name:32s} rows-only  spark={len(srows)} ({ts:.1f}s)", flush=True)
            continue
        rel = con.sql(sqls[name])
        dcols = rel.columns
        drows = rows_of(dcols, rel.fetchall())
        ok_cols = sorted(cols) == sorted(dcols)
        ok = ok_cols and srows == drows
        results[name] = ("match" if ok else "MISMATCH", len(srows), ts)
        if verbose:
            print(f"{name:32s} {'match' if ok else 'MISMATCH':9s} spark={len(srows)} duck={len(drows)} ({ts:.1f}s)",
                  flush=True)
            if not ok_cols:
                print("   spark cols", sorted(cols), "\n   duck  cols", sorted(dcols))
            elif not ok:
                a, b = set(srows), set(drows)
                print("   only spark:", sorted(a - b, key=repr)[:3])
                print("   only duck: ", sorted(b - a, key=repr)[:3])
    return results


if __name__ == "__main__":
    from shelfrank.plans.session import build_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session()
    res = check(spark, sf, sys.argv[2:] or None)
    bad = [k for k, v in res.items() if v[0] == "MISMATCH"]
    print("mismatches:", bad)
