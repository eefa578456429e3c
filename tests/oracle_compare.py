"""Compare every ``queries()`` result with its ``oracle_sql()`` twin in DuckDB.

Usage: python tests/oracle_compare.py [sf_dir] [key ...]

Row count, column names and an order-insensitive comparison of values
(floats to 6 significant digits) per key. Used by the test suite and by hand.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return float(f"{v:.6g}")
    if isinstance(v, decimal.Decimal):
        return float(f"{float(v):.6g}")
    if isinstance(v, bool):
        return v
    if isinstance(v, int):
        return v
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def rows_key(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def compare(spark, sf_dir: str, keys=None, verbose=True):
    import __spark_entry__ as E

    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    results = {}
    for k in keys or qs:
        t0 = time.time()
        try:
            sdf = qs[k](spark, sf_dir)
            s_cols = sdf.columns
            s_rows = [tuple(r) for r in sdf.collect()]
            t1 = time.time()
            if k not in sqls:
                results[k] = ("rows-only", len(s_rows), None)
                continue
            cur = con.execute(sqls[k])
            d_cols = [c[0] for c in cur.description]
            d_rows = cur.fetchall()
            ok_cols = sorted(s_cols) == sorted(d_cols)
            ok_n = len(s_rows) == len(d_rows)
            ok_v = ok_cols and ok_n and rows_key(s_rows, s_cols) == rows_key(d_rows, d_cols)
            status = "OK" if (ok_cols and ok_n and ok_v) else "FAIL"
            detail = "" if status == "OK" else f"cols={ok_cols} n={len(s_rows)}/{len(d_rows)} vals={ok_v}"
            if status != "OK" and ok_cols and ok_n:
                a, b = rows_key(s_rows, s_cols), rows_key(d_rows, d_cols)
                diff = [(x, y) for x, y in zip(a, b) if x != y][:2]
                detail += f" first diffs={diff} cols={sorted(s_cols)}"
            elif not ok_cols:
                detail += f" spark={sorted(s_cols)} duck={sorted(d_cols)}"
            results[k] = (status, len(s_rows), detail)
            if verbose:
                print(f"{status:5s} {k:28s} rows={len(s_rows):7d} spark={t1 - t0:6.2f}s {detail}", flush=True)
        except Exception as e:  # report and go on with the next key
            results[k] = ("ERROR", None, repr(e)[:400])
            if verbose:
                print(f"ERROR {k:28s} {repr(e)[:400]}", flush=True)
    return results


if __name__ == "__main__":
    from gustolake.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    keys = sys.argv[2:] or None
    spark = build_session(
        "local[8]", shuffle_partitions=8,
        extra={"spark.driver.memory": "16g", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    res = compare(spark, sf, keys)
    bad = {k: v for k, v in res.items() if v[0] not in ("OK", "rows-only")}
    print(f"{len(res) - len(bad)}/{len(res)} ok")
    sys.exit(1 if bad else 0)
