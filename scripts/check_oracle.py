"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

Usage: python scripts/check_oracle.py [sf_dir] [name ...]
Prints one line per query: rows, column names and an order-insensitive
value comparison.
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from civicstat.plans.catalog import QUERIES  # noqa: E402
from civicstat.plans.oracle import SQL  # noqa: E402
from civicstat.session import build_session  # noqa: E402
from civicstat.sources.tables import TABLES  # noqa: E402


def norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        if math.isnan(v):
            return "∅"
        return repr(float(v))
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(norm(x) for x in v) + "]"
    if hasattr(v, "tolist"):
        return norm(v.tolist())
    return str(v)


def rows_of(records, cols):
    return sorted(tuple(norm(r[c]) for c in cols) for r in records)


def main():
    args = sys.argv[1:]
    sf_dir = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in args if not a.startswith("/")] or list(QUERIES)
    spark = build_session("local[8]")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    bad = 0
    for name in names:
        t0 = time.time()
        try:
            sdf = QUERIES[name](spark, sf_dir)
            srows = [r.asDict(recursive=True) for r in sdf.collect()]
            scols = sorted(sdf.columns)
        except Exception as e:  # noqa: BLE001
            print(f"{name:28s} SPARK-ERROR {type(e).__name__}: {str(e)[:300]}")
            bad += 1
            continue
        ts = time.time() - t0
        if name not in SQL:
            print(f"{name:28s} rows={len(srows):7d} (no oracle) {ts:.1f}s")
            continue
        try:
            cur = con.execute(SQL[name])
            dcols = [d[0] for d in cur.description]
            drows = [dict(zip(dcols, r)) for r in cur.fetchall()]
        except Exception as e:  # noqa: BLE001
            print(f"{name:28s} SQL-ERROR {str(e)[:300]}")
            bad += 1
            continue
        if sorted(dcols) != scols:
            print(f"{name:28s} COLS differ spark={scols} sql={sorted(dcols)}")
            bad += 1
            continue
        a, b = rows_of(srows, scols), rows_of(drows, scols)
        ok = a == b
        bad += not ok
        msg = "OK" if ok else "VALUES DIFFER"
        print(f"{name:28s} rows={len(a):7d}/{len(b):7d} {msg} {ts:.1f}s")
        if not ok:
            sa, sb = set(a), set(b)
            print("   spark-only:", list(sa - sb)[:3])
            print("   sql-only:  ", list(sb - sa)[:3])
    spark.stop()
    sys.exit(1 if bad else 0)


if __name__ == "__main__":
    main()
