"""Spark query vs DuckDB oracle: row count, column names and an
order-insensitive multiset of canonicalised rows.

Usable from pytest and as a script:  python tests/oracle_check.py [sf_dir] [key ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import os
import sys
import time
from collections import Counter

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def canon(v):
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "T" if v else "F"
    if isinstance(v, float):
        return f"{v:.9g}"
    if isinstance(v, decimal.Decimal):
        return f"{float(v):.9g}" if v != v.to_integral_value() else str(int(v))
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(canon(x) for x in v) + "]"
    if isinstance(v, dict):
        return "{" + ",".join(f"{k}:{canon(x)}" for k, x in sorted(v.items())) + "}"
    if hasattr(v, "asDict"):
        return canon(v.asDict())
    return str(v)


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(spark, key: str, sf_dir: str, con=None) -> dict:
    from __spark_entry__ import oracle_sql, queries
    t0 = time.time()
    sdf = queries()[key](spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    out = {"key": key, "spark_rows": len(s_rows), "spark_sec": round(t1 - t0, 2)}
    sql = oracle_sql().get(key)
    if sql is None:
        out["oracle"] = "none"
        return out
    con = con or duck(sf_dir)
    cur = con.execute(sql)
    d_cols = [c[0] for c in cur.description]
    d_rows = cur.fetchall()
    out["duck_rows"] = len(d_rows)
    out["cols_match"] = sorted(s_cols) == sorted(d_cols)
    if not out["cols_match"]:
        out["spark_cols"], out["duck_cols"] = s_cols, d_cols
        return out
    order = sorted(s_cols)
    si = [s_cols.index(c) for c in order]
    di = [d_cols.index(c) for c in order]
    s_bag = Counter(tuple(canon(r[i]) for i in si) for r in s_rows)
    d_bag = Counter(tuple(canon(r[i]) for i in di) for r in d_rows)
    out["values_match"] = s_bag == d_bag
    if not out["values_match"]:
        only_s = list((s_bag - d_bag).elements())[:3]
        only_d = list((d_bag - s_bag).elements())[:3]
        out["cols"] = order
        out["only_spark"], out["only_duck"] = only_s, only_d
    return out


if __name__ == "__main__":
    from murmur.session import get_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session("local[8]", 8)
    from __spark_entry__ import queries
    keys = sys.argv[2:] or sorted(queries())
    con = duck(sf)
    bad = 0
    for k in keys:
        try:
            r = compare(spark, k, sf, con)
        except Exception as e:  # report and continue with the next key
            r = {"key": k, "error": (str(e).strip().splitlines() or [repr(e)])[0][:600]}
        ok = r.get("values_match") and r.get("spark_rows") == r.get("duck_rows")
        bad += 0 if ok or r.get("oracle") == "none" else 1
        print(("OK  " if ok else "--  ") + str(r), flush=True)
    print("mismatches:", bad)
