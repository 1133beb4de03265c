"""Spark-vs-DuckDB comparison used by the oracle tests and ``python tests/harness.py``.

Rows are compared order-insensitively after sorting columns by name; every value
is rendered to a canonical text (timestamps ISO, floats ``repr``, bytes hex).
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

import duckdb
import pandas as pd

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def canon(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NULL"
        if v == int(v) and abs(v) < 1e15:
            return str(int(v))
        return repr(v)
    if isinstance(v, (pd.Timestamp, dt.datetime)):
        return pd.Timestamp(v).isoformat()
    if isinstance(v, (bytes, bytearray, memoryview)):
        return bytes(v).hex()
    if hasattr(v, "item"):
        return canon(v.item())
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(canon(x) for x in v) + "]"
    if isinstance(v, dict):
        return "{" + ",".join(f"{k}:{canon(x)}" for k, x in sorted(v.items())) + "}"
    return str(v)


def rows_of(columns: list[str], records: list[tuple]) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cols = [columns[i] for i in order]
    rows = sorted(tuple(canon(r[i]) for i in order) for r in records)
    return cols, rows


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    recs = [tuple(r) for r in df.collect()]
    return rows_of(df.columns, recs)


def duck_rows(con, sql: str) -> tuple[list[str], list[tuple]]:
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    return rows_of(cols, cur.fetchall())


def compare(spark, name: str, sf_dir: str, con=None) -> dict:
    import __spark_entry__ as E
    q = E.queries()[name]
    sql = E.oracle_sql().get(name)
    t0 = time.time()
    s_cols, s_rows = spark_rows(q(spark, sf_dir))
    t1 = time.time()
    res = {"name": name, "spark_rows": len(s_rows), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        res["status"] = "rows-only"
        return res
    con = con or duck(sf_dir)
    d_cols, d_rows = duck_rows(con, sql)
    res.update(duck_rows=len(d_rows), duck_sec=round(time.time() - t1, 2))
    if s_cols != d_cols:
        res["status"] = "schema"
        res["detail"] = f"spark={s_cols} duck={d_cols}"
    elif s_rows != d_rows:
        res["status"] = "values"
        sset, dset = set(s_rows), set(d_rows)
        res["detail"] = {"only_spark": sorted(sset - dset)[:3], "only_duck": sorted(dset - sset)[:3]}
    else:
        res["status"] = "ok"
    return res


if __name__ == "__main__":
    from hexvault.session import build_session
    sf = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    names = sys.argv[1:]
    spark = build_session("local[8]", 8)
    import __spark_entry__ as E
    con = duck(sf)
    bad = 0
    for n in names or list(E.queries()):
        try:
            r = compare(spark, n, sf, con)
        except Exception as e:  # report and continue
            r = {"name": n, "status": "error", "detail": repr(e)[:400]}
        if r["status"] not in ("ok", "rows-only"):
            bad += 1
        print(r, flush=True)
    print("FAILED" if bad else "ALL OK", bad)
