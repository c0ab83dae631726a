"""Compare registered Spark queries with their DuckDB oracle SQL.

Usage: python tests/oracle_check.py [sf_dir] [key ...]
Row count, column names and an order-insensitive multiset of normalized
row values must agree.
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "documents", "embeddings", "pages", "benchmark", "labels"]


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    try:
        import pandas as pd
        if v is pd.NA or v is pd.NaT:
            return None
    except Exception:
        pass
    if isinstance(v, bool):
        return v
    if isinstance(v, (int,)) and not isinstance(v, bool):
        return float(v)
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 9)
    if hasattr(v, "item"):
        return _norm(v.item())
    return str(v)


def rows_of(records):
    return Counter(tuple(_norm(x) for x in r) for r in records)


def compare(spark, sf_dir: str, key: str, fn, sql: str | None, con) -> dict:
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t_spark = time.time() - t0
    out = {"key": key, "spark_rows": len(s_rows), "spark_sec": round(t_spark, 2)}
    if sql is None:
        out["status"] = "rows-only"
        return out
    rel = con.sql(sql)
    d_cols = rel.columns
    d_rows = rel.fetchall()
    out["oracle_rows"] = len(d_rows)
    if sorted(s_cols) != sorted(d_cols):
        out["status"] = f"columns differ: spark={s_cols} oracle={d_cols}"
        return out
    order = sorted(range(len(s_cols)), key=lambda i: s_cols[i])
    d_idx = {c: i for i, c in enumerate(d_cols)}
    s_norm = rows_of([tuple(r[i] for i in order) for r in s_rows])
    d_norm = rows_of([tuple(r[d_idx[s_cols[i]]] for i in order) for r in d_rows])
    if s_norm == d_norm:
        out["status"] = "match"
    else:
        only_s = list((s_norm - d_norm).elements())[:3]
        only_d = list((d_norm - s_norm).elements())[:3]
        out["status"] = f"values differ; spark-only={only_s} oracle-only={only_d}"
    return out


def main(argv):
    sys.path.insert(0, ".")
    import __spark_entry__ as E
    from tillroll.session import build_session
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    keys = argv[2:]
    spark = build_session()
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for k in (keys or list(qs)):
        try:
            r = compare(spark, sf_dir, k, qs[k], sqls.get(k), con)
        except Exception as e:  # report and continue
            r = {"key": k, "status": f"ERROR {type(e).__name__}: {str(e)[:400]}"}
        if r["status"] not in ("match", "rows-only"):
            bad += 1
        print(r, flush=True)
    print(f"{bad} problems")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
