"""Run registered queries in Spark and their DuckDB twins; compare results.

Usage: python tests/oracle_check.py [sf_dir] [name ...]

Mirrors the driver's check: row count, column names and an order-insensitive
hash of the values. Prints one line per query and exits non-zero on mismatch.
"""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def norm(v):
    if v is None:
        return "NULL"
    try:
        import pandas as pd
        if v is pd.NaT:
            return "NULL"
    except Exception:
        pass
    if isinstance(v, float):
        if math.isnan(v):
            return "NULL"
        if v == int(v) and abs(v) < 1e15:
            return str(int(v))
        return repr(round(v, 6))
    if isinstance(v, (bool,)):
        return str(v)
    if isinstance(v, int):
        return str(v)
    if isinstance(v, decimal.Decimal):
        return norm(float(v))
    if hasattr(v, "isoformat"):
        if isinstance(v, dt.datetime) or hasattr(v, "to_pydatetime"):
            return v.isoformat(sep=" ")
        return v.isoformat()
    if hasattr(v, "item"):
        return norm(v.item())
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(norm(x) for x in v) + "]"
    return str(v)


def digest(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("|".join(norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest(), lines


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if not a.startswith("/")]
    import __spark_entry__ as E
    from sparksweep.session import local_session
    spark = local_session()
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for name in (names or list(qs)):
        t0 = time.time()
        try:
            sdf = qs[name](spark, sf_dir)
            scols = sdf.columns
            srows = [tuple(r) for r in sdf.collect()]
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: spark error {type(e).__name__}: {str(e)[:400]}")
            bad += 1
            continue
        ts = time.time() - t0
        if name not in sqls:
            print(f"ROWS {name}: {len(srows)} rows (no oracle) {ts:.1f}s")
            continue
        try:
            res = con.sql(sqls[name])
            dcols = res.columns
            drows = res.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: duckdb error {str(e)[:400]}")
            bad += 1
            continue
        sh, sl = digest(scols, srows)
        dh, dl = digest(dcols, drows)
        ok = sorted(scols) == sorted(dcols) and len(srows) == len(drows) and sh == dh
        if ok:
            print(f"OK   {name}: {len(srows)} rows {ts:.1f}s")
        else:
            bad += 1
            print(f"FAIL {name}: spark {len(srows)} rows {sorted(scols)} / duck {len(drows)} rows {sorted(dcols)}")
            ds = sorted(set(sl) - set(dl))[:3]
            dd = sorted(set(dl) - set(sl))[:3]
            print("   spark-only:", ds)
            print("   duck-only: ", dd)
    spark.stop()
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
