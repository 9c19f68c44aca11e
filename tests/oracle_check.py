"""Compare each registered Spark query with its DuckDB oracle.

Usage: python -m tests.oracle_check [sf_dir] [name ...]
Checks row count, column names and an order-insensitive multiset of rows.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
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
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((str(k), _norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return _norm(v.asDict())
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(columns), sorted(out, key=repr)


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_rows = sdf.collect()
    t1 = time.time()
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    s_cols, s_vals = rows_of(sdf.columns, s_rows)
    d_cols, d_vals = rows_of(d_cols, d_rows)
    ok = s_cols == d_cols and s_vals == d_vals
    detail = ""
    if not ok:
        if s_cols != d_cols:
            detail = f"columns spark={s_cols} duck={d_cols}"
        elif len(s_vals) != len(d_vals):
            detail = f"rows spark={len(s_vals)} duck={len(d_vals)}"
        else:
            diff = [(a, b) for a, b in zip(s_vals, d_vals) if a != b][:3]
            detail = f"first diffs: {diff}"
    return ok, len(s_vals), len(d_vals), t1 - t0, detail


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if not a.startswith("/")]
    sys.path.insert(0, ".")
    import __spark_entry__ as E
    from tests.conftest import make_spark

    spark = make_spark()
    con = duck(sf_dir)
    qs, oracle = E.queries(), E.oracle_sql()
    bad = 0
    for name in names or sorted(qs):
        if name not in oracle:
            df = qs[name](spark, sf_dir)
            print(f"{name:32s} NO-ORACLE rows={df.count()}")
            continue
        try:
            ok, ns, nd, secs, detail = compare(spark, con, name, qs[name], oracle[name], sf_dir)
        except Exception as e:  # report and go on
            ok, ns, nd, secs, detail = False, -1, -1, 0.0, f"{type(e).__name__}: {str(e)[:400]}"
        bad += not ok
        print(f"{name:32s} {'OK ' if ok else 'BAD'} spark={ns} duck={nd} {secs:6.2f}s {detail}", flush=True)
    print(f"{bad} mismatches")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
