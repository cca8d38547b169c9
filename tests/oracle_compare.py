"""Compare registered Spark queries with their DuckDB oracle SQL.

Usage: ``python tests/oracle_compare.py [sf_dir] [name ...]``.
Prints one line per query and exits non-zero on any mismatch.
"""

from __future__ import annotations

import datetime as _dt
import decimal
import math
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, _dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, _dt.date):
        return v.isoformat()
    if isinstance(v, bool):
        return int(v)
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


def compare(spark, sf_dir: str, names=None):
    import __spark_entry__ as E
    from cardwatch.plans.registry import QUERIES
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    results = {}
    for name in names or list(QUERIES):
        df = qs[name](spark, sf_dir)
        s_cols = df.columns
        s_rows = [tuple(r) for r in df.collect()]
        if name not in sqls:
            results[name] = ("no-oracle", len(s_rows))
            continue
        cur = con.execute(sqls[name])
        d_cols = [d[0] for d in cur.description]
        d_rows = cur.fetchall()
        ok_cols = sorted(s_cols) == sorted(d_cols)
        ok_vals = ok_cols and _rows(s_cols, s_rows) == _rows(d_cols, d_rows)
        results[name] = ("ok" if ok_vals else "MISMATCH", len(s_rows), len(d_rows),
                         None if ok_cols else (sorted(s_cols), sorted(d_cols)))
    return results


if __name__ == "__main__":
    from cardwatch.session import build_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", 8)
    res = compare(spark, sf, sys.argv[2:] or None)
    bad = 0
    for k, v in res.items():
        print(f"{k:34s} {v}")
        bad += v[0] == "MISMATCH"
    sys.exit(1 if bad else 0)
