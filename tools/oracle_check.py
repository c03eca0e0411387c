"""Compare every registered query with its DuckDB oracle on one data directory.

usage: python tools/oracle_check.py [sf_dir] [name-substring ...]

Reports per query: row counts, column names, and whether the multisets of rows
are equal exactly ("exact") or only with a float tolerance ("approx").
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def norm(v, approx=False):
    if v is None:
        return None
    if isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return round(v, 6) if approx else v
    if isinstance(v, dt.datetime):
        return v.isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x, approx) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, norm(x, approx)) for k, x in v.items()))
    return v


def rows_of(cols, rows, approx=False):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(norm(r[i], approx) for i in order) for r in rows)


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    pats = sys.argv[2:]
    from martspark.catalog import ORACLES, QUERIES
    from martspark.session import local_session

    spark = local_session(8)
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"create view {t} as select * from read_parquet('{p}')")
    names = [n for n in QUERIES if not pats or any(p in n for p in pats)]
    bad = 0
    for name in names:
        t0 = time.time()
        try:
            df = QUERIES[name](spark, sf_dir)
            scols = df.columns
            srows = [tuple(r) for r in df.collect()]
        except Exception as e:  # noqa: BLE001
            print(f"{name:40s} SPARK-ERROR {type(e).__name__}: {str(e)[:300]}")
            bad += 1
            continue
        ts = time.time() - t0
        if name not in ORACLES:
            print(f"{name:40s} rows={len(srows):7d} (no oracle) {ts:.1f}s")
            continue
        try:
            res = con.execute(ORACLES[name])
            ocols = [d[0] for d in res.description]
            orows = res.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"{name:40s} ORACLE-ERROR {str(e)[:400]}")
            bad += 1
            continue
        status = "exact"
        if sorted(scols) != sorted(ocols):
            status = f"COLS spark-only={sorted(set(scols) - set(ocols))} oracle-only={sorted(set(ocols) - set(scols))}"
        elif len(srows) != len(orows):
            status = f"ROWS spark={len(srows)} oracle={len(orows)}"
        elif rows_of(scols, srows) != rows_of(ocols, orows):
            if rows_of(scols, srows, True) == rows_of(ocols, orows, True):
                status = "approx"
            else:
                a, b = rows_of(scols, srows, True), rows_of(ocols, orows, True)
                sa, sb = list((a - b).elements())[:2], list((b - a).elements())[:2]
                status = f"VALUES spark-only={sa} oracle-only={sb} cols={sorted(scols)}"
        if status != "exact":
            bad += 1
        print(f"{name:40s} rows={len(srows):7d} {status} {ts:.1f}s", flush=True)
    print(f"checked={len(names)} not-exact={bad}")
    spark.stop()


if __name__ == "__main__":
    main()
