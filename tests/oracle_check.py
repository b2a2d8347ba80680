"""Run registered queries in Spark and their oracle SQL in DuckDB; compare like the driver does
(row count, column names, order-insensitive normalised values).

    python tests/oracle_check.py [sf_dir] [query ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

import duckdb  # noqa: I001

HERE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, HERE)

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


#: Queries whose result has an order, and the columns that it is an order by.
ORDERED = {
    "fact_dim_left": ["FacilityName", "MeasureName"], "facility_comparison": ["wi_high_score", "FacilityName"],
    "model_calendar": ["Date"], "calendar_usage": ["Date"],
}


def norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float) and math.isnan(v):
        return "∅"
    if isinstance(v, (decimal.Decimal, float)):
        return f"{float(v):.6f}"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, int):
        return f"{float(v):.6f}"
    if isinstance(v, dt.datetime):
        return v.isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return str(v)


def duck(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def rows_of(cols, tuples):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(norm(r[i]) for i in order) for r in tuples)


def compare(spark, name, fn, sql, con, sf):
    t0 = time.time()
    sdf = fn(spark, sf)
    s_rows = [tuple(r) for r in sdf.collect()]
    s_cols = sdf.columns
    t1 = time.time()
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    t2 = time.time()
    problems = []
    if sorted(s_cols) != sorted(d_cols):
        problems.append(f"columns spark={sorted(s_cols)} duck={sorted(d_cols)}")
    if len(s_rows) != len(d_rows):
        problems.append(f"rows spark={len(s_rows)} duck={len(d_rows)}")
    if not problems:
        a, b = rows_of(s_cols, s_rows), rows_of(d_cols, d_rows)
        if a != b:
            diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
            problems.append(f"values differ e.g. {diff}")
    if not problems and name in ORDERED:
        seen = [[[norm(r[cols.index(c)]) for c in ORDERED[name]] for r in rows]
                for cols, rows in ((s_cols, s_rows), (d_cols, d_rows))]
        if seen[0] != seen[1]:
            problems.append("order differs")
    status = "OK " if not problems else "BAD"
    print(f"{status} {name:32s} rows={len(s_rows):7d} spark={t1 - t0:6.1f}s duck={t2 - t1:5.1f}s "
          + "; ".join(problems), flush=True)
    return not problems


def main(argv):
    sf = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    only = set(argv[2:])
    from qualmart.session import build_session
    import __spark_entry__ as E
    spark = build_session()
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf)
    ok = bad = 0
    for name, fn in qs.items():
        if only and name not in only:
            continue
        if name not in sqls:
            print(f"--  {name:32s} (no oracle)")
            continue
        try:
            good = compare(spark, name, fn, sqls[name], con, sf)
        except Exception as e:  # noqa: BLE001
            print(f"ERR {name:32s} {type(e).__name__}: {str(e)[:400]}", flush=True)
            good = False
        ok += good
        bad += not good
    print(f"{ok} ok, {bad} bad")


if __name__ == "__main__":
    main(sys.argv)
