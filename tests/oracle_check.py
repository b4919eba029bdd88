"""Run a registered Spark query and its DuckDB oracle side by side and compare.

Usable from pytest (``compare``) and as a script:
``python tests/oracle_check.py /root/testdata/sf0.01 [name ...]``.
"""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

DRIVER_TABLES = ("region nation customer supplier part orders lineitem events documents "
                 "embeddings pages benchmark labels conversations").split()


def duck_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
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
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat(sep=" ") if isinstance(v, dt.datetime) else v.isoformat()
    if isinstance(v, bool):
        return v
    if isinstance(v, int):
        return v
    return v


def canonical(columns: list[str], rows: list[tuple]) -> tuple[list[str], str, int]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    normed = sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows)
    h = hashlib.sha256("\n".join(normed).encode()).hexdigest()
    return names, h, len(rows)


def spark_rows(df):
    return df.columns, [tuple(r) for r in df.collect()]


def duck_rows(con, sql):
    rel = con.execute(sql)
    cols = [d[0] for d in rel.description]
    return cols, rel.fetchall()


def compare(spark, name: str, sf_dir: str, queries: dict, oracle: dict) -> dict:
    t0 = time.time()
    s_cols, s_rows = spark_rows(queries[name](spark, sf_dir))
    t1 = time.time()
    con = duck_connection(sf_dir)
    d_cols, d_rows = duck_rows(con, oracle[name])
    t2 = time.time()
    s = canonical(s_cols, s_rows)
    d = canonical(d_cols, d_rows)
    return {"name": name, "spark_rows": s[2], "oracle_rows": d[2],
            "schema_match": s[0] == d[0], "hash_match": s[1] == d[1],
            "spark_cols": s_cols, "oracle_cols": d_cols,
            "spark_sec": round(t1 - t0, 2), "oracle_sec": round(t2 - t1, 2),
            "ok": s[0] == d[0] and s[1] == d[1] and s[2] == d[2]}


def first_difference(spark, name, sf_dir, queries, oracle, limit=5):
    s_cols, s_rows = spark_rows(queries[name](spark, sf_dir))
    d_cols, d_rows = duck_rows(duck_connection(sf_dir), oracle[name])
    order_s = sorted(range(len(s_cols)), key=lambda i: s_cols[i])
    order_d = sorted(range(len(d_cols)), key=lambda i: d_cols[i])
    ss = {repr(tuple(_norm(r[i]) for i in order_s)) for r in s_rows}
    dd = {repr(tuple(_norm(r[i]) for i in order_d)) for r in d_rows}
    return sorted(ss - dd)[:limit], sorted(dd - ss)[:limit], sorted(s_cols)


if __name__ == "__main__":
    import __spark_entry__ as E
    from curbwise.session import get_spark

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = get_spark("local[8]", 8)
    spark.sparkContext.setLogLevel("ERROR")
    qs, orc = E.queries(), E.oracle_sql()
    bad = 0
    for n in names or list(qs):
        if n not in orc:
            df = qs[n](spark, sf)
            print(f"{n:36s} rows-only {df.count()}")
            continue
        try:
            r = compare(spark, n, sf, qs, orc)
        except Exception as e:  # report and continue
            print(f"{n:36s} ERROR {type(e).__name__}: {str(e)[:300]}")
            bad += 1
            continue
        flag = "OK " if r["ok"] else "BAD"
        bad += not r["ok"]
        print(f"{n:36s} {flag} spark={r['spark_rows']} oracle={r['oracle_rows']} "
              f"schema={r['schema_match']} hash={r['hash_match']} {r['spark_sec']}s/{r['oracle_sec']}s")
        if not r["ok"]:
            if not r["schema_match"]:
                print("   spark cols:", sorted(r["spark_cols"]))
                print("   duck  cols:", sorted(r["oracle_cols"]))
            else:
                a, b, cols = first_difference(spark, n, sf, qs, orc)
                print("   cols:", cols)
                for x in a:
                    print("   spark-only:", x)
                for x in b:
                    print("   duck-only: ", x)
    print("failures:", bad)
