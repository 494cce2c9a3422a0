"""Run a registered query on Spark and its oracle on DuckDB, and compare.

Mirrors the driver's correctness gate: column names (sorted), row count and
an order-insensitive comparison of the values. Floats are compared exactly
and, separately, to 1e-9 relative, so a summation-order difference shows up
as ``exact=False`` without failing ``match``.
"""

from __future__ import annotations

import datetime as dt
import math
import sys

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duckdb_connection(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v, exact: bool):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):
            return (0, "")
        return (1, repr(v) if exact else f"{v:.9g}")
    if isinstance(v, dt.datetime):
        return (1, v.replace(tzinfo=None).isoformat())
    if isinstance(v, dt.date):
        return (1, v.isoformat())
    if isinstance(v, bool):
        return (1, str(int(v)))
    return (1, str(v))


def _rows(columns, rows, exact):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_norm(r[i], exact) for i in order) for r in rows)


def compare(spark, name, query, sql, sf_dir, con=None):
    con = con or duckdb_connection(sf_dir)
    df = query(spark, sf_dir)
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    res = con.execute(sql)
    d_cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    out = {
        "query": name,
        "names": sorted(s_cols) == sorted(d_cols),
        "rows": (len(s_rows), len(d_rows)),
    }
    if out["names"]:
        out["exact"] = _rows(s_cols, s_rows, True) == _rows(d_cols, d_rows, True)
        out["match"] = out["exact"] or _rows(s_cols, s_rows, False) == _rows(d_cols, d_rows, False)
    else:
        out["exact"] = out["match"] = False
        out["spark_cols"] = sorted(s_cols)
        out["oracle_cols"] = sorted(d_cols)
    out["ok"] = out["names"] and out["match"] and len(s_rows) == len(d_rows)
    return out


if __name__ == "__main__":
    import os

    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as E
    from arrivals_mart.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(E.queries())
    spark = build_session(master="local[8]", conf={"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb_connection(sf)
    oracles = E.oracle_sql()
    bad = 0
    for n in names:
        q = E.queries()[n]
        if n not in oracles:
            print(n, "rows-only", q(spark, sf).count(), flush=True)
            continue
        try:
            r = compare(spark, n, q, oracles[n], sf, con)
        except Exception as e:  # report and continue
            r = {"query": n, "ok": False, "error": str(e)[:600]}
        bad += not r["ok"]
        print(r, flush=True)
    print("FAILED" if bad else "ALL OK", bad)
