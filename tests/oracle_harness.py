"""Differential check: Spark query vs DuckDB oracle SQL on the same parquet tables.

Usage: python tests/oracle_harness.py [sf_dir] [name ...]
Compares row count, column names and an order-insensitive multiset of rows
(columns sorted by name, as the driver does).
"""

from __future__ import annotations

import collections
import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(round(v, 9))
    if isinstance(v, (list, tuple)):
        return repr([_norm(x) for x in v])
    if isinstance(v, dict):
        return repr(sorted((k, _norm(x)) for k, x in v.items()))
    if hasattr(v, "as_integer_ratio") and not isinstance(v, int):  # Decimal
        return repr(float(v))
    return repr(v)


def rows_multiset(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return collections.Counter(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    scols = sdf.columns
    srows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    res = {"name": name, "spark_rows": len(srows), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        res["status"] = "rows-only"
        return res
    cur = con.execute(sql)
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    res["duck_rows"] = len(drows)
    if sorted(scols) != sorted(dcols):
        res["status"] = f"COLUMNS {sorted(scols)} vs {sorted(dcols)}"
        return res
    a, b = rows_multiset(scols, srows), rows_multiset(dcols, drows)
    if a == b:
        res["status"] = "ok"
    else:
        only_s = list((a - b).elements())[:3]
        only_d = list((b - a).elements())[:3]
        res["status"] = f"VALUES spark-only={only_s} duck-only={only_d}"
    return res


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    from quarry.session import get_spark
    import __spark_entry__ as E

    spark = get_spark()
    con = duck(sf_dir)
    qs, oracle = E.queries(), E.oracle_sql()
    bad = 0
    for name in names or list(qs):
        try:
            r = compare(spark, con, name, qs[name], oracle.get(name), sf_dir)
        except Exception as e:  # report and continue
            r = {"name": name, "status": f"ERROR {type(e).__name__}: {str(e)[:400]}"}
        if r["status"] not in ("ok", "rows-only"):
            bad += 1
        print(r, flush=True)
    print(f"{bad} failing of {len(names or qs)}")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
