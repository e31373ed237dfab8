"""Run registered queries in Spark and their SQL twins in DuckDB, compare results.

    python tests/oracle_check.py [sf_dir] [name ...]

Compares row count, column names and the multiset of rows (floats as repr).
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

import __spark_entry__ as E  # noqa: E402
from blogscope.session import get_session  # noqa: E402
from blogscope.sources.tables import TABLES  # noqa: E402


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else repr(round(v, 9))
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return str(v)


def _rows(records, cols):
    return sorted((tuple(_norm(r[c]) for c in cols) for r in records), key=repr)


def main():
    args = sys.argv[1:]
    sf = args[0] if args and os.path.isdir(args[0]) else "/root/testdata/sf0.01"
    names = [a for a in args if not os.path.isdir(a)]
    spark = get_session("local[8]", 8)
    con = duckdb.connect()
    con.execute("SET enable_progress_bar = false")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    qs, sqls = E.queries(), E.oracle_sql()
    ok_all = True
    for name, fn in qs.items():
        if names and name not in names:
            continue
        if name in sqls:
            res = con.execute(sqls[name])
            dcols = [d[0] for d in res.description]
            drows = [dict(zip(dcols, r)) for r in res.fetchall()]
        t0 = time.time()
        sdf = fn(spark, sf)
        srows = [r.asDict() for r in sdf.collect()]
        t1 = time.time()
        if name not in sqls:
            print(f"{name}: spark rows={len(srows)} ({t1 - t0:.1f}s) no oracle")
            continue
        scols = sorted(sdf.columns)
        same_cols = scols == sorted(dcols)
        ok = same_cols and len(srows) == len(drows)
        if ok:
            a, b = _rows(srows, scols), _rows(drows, scols)
            ok = a == b
            if not ok:
                diff = [x for x in a if x not in set(b)][:3]
                diff2 = [x for x in b if x not in set(a)][:3]
                print("   spark-only:", diff, "\n   duck-only:", diff2)
        ok_all &= ok
        print(f"{name}: {'OK' if ok else 'MISMATCH'} spark={len(srows)} duck={len(drows)} "
              f"cols={'same' if same_cols else (scols, sorted(dcols))} ({t1 - t0:.1f}s)", flush=True)
    spark.stop()
    sys.exit(0 if ok_all else 1)


if __name__ == "__main__":
    main()
