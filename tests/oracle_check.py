"""Compare registered Spark queries with their DuckDB oracle SQL.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
Mirrors the driver's check: row count, column names, order-insensitive values.
"""

from __future__ import annotations

import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, int(os.environ.get("ORACLE_DIGITS", "12")))
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def rows_of(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in records]
    return sorted(out, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    res = con.execute(sql)
    d_cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    ok_cols = sorted(s_cols) == sorted(d_cols)
    ok_n = len(s_rows) == len(d_rows)
    ok_v = ok_cols and ok_n and rows_of(s_cols, s_rows) == rows_of(d_cols, d_rows)
    detail = ""
    if not ok_cols:
        detail = f"cols spark={sorted(s_cols)} duck={sorted(d_cols)}"
    elif not ok_n:
        detail = f"rows spark={len(s_rows)} duck={len(d_rows)}"
    elif not ok_v:
        a, b = rows_of(s_cols, s_rows), rows_of(d_cols, d_rows)
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        detail = f"first diffs {diff}"
    return ok_cols and ok_n and ok_v, len(s_rows), t1 - t0, detail


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    import __spark_entry__ as E
    from ledgerlens.session import get_session
    spark = get_session("local[8]", 8)
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for name in names or sorted(sqls):
        try:
            ok, n, secs, detail = compare(spark, con, name, qs[name], sqls[name], sf_dir)
        except Exception as e:  # noqa: BLE001
            ok, n, secs, detail = False, -1, 0.0, f"{type(e).__name__}: {str(e)[:400]}"
        bad += not ok
        print(f"{'OK ' if ok else 'BAD'} {name:28s} rows={n:7d} {secs:6.2f}s {detail}", flush=True)
    missing = sorted(set(qs) - set(sqls))
    print("no oracle:", missing)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv))
