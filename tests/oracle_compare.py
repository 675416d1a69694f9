"""Run driver queries in Spark and their DuckDB SQL side by side and
compare row count, column names and order-insensitive values.

    python tests/oracle_compare.py [name ...] [--sf DIR]
"""

from __future__ import annotations

import argparse
import hashlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def duck(sf: str):
    import duckdb
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


_SPARK2DUCK = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN",
               "double": "DOUBLE", "timestamp": "TIMESTAMP", "date": "DATE"}


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return repr(round(v, 6))
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    if isinstance(v, bool):
        return str(v)
    return str(v)


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("\x1f".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest(), lines


def compare(spark, con, name, fn, sql, sf):
    t0 = time.time()
    sdf = fn(spark, sf)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    t2 = time.time()
    s_types = {f.name: _SPARK2DUCK.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in sdf.schema.fields}
    d_types = {d[0]: str(d[1]) for d in res.description}
    type_diff = {c: (s_types.get(c), d_types.get(c)) for c in s_types if s_types.get(c) != d_types.get(c)}
    sh, sl = digest(s_cols, s_rows)
    dh, dl = digest(d_cols, d_rows)
    ok = sorted(s_cols) == sorted(d_cols) and len(s_rows) == len(d_rows) and sh == dh
    info = dict(name=name, ok=ok, spark_rows=len(s_rows), duck_rows=len(d_rows),
                cols_ok=sorted(s_cols) == sorted(d_cols), spark_s=round(t1 - t0, 2), duck_s=round(t2 - t1, 2))
    if type_diff:
        info["type_diff"] = type_diff
    if not ok:
        info["spark_cols"], info["duck_cols"] = s_cols, d_cols
        only_s = sorted(set(sl) - set(dl))[:3]
        only_d = sorted(set(dl) - set(sl))[:3]
        info["only_spark"] = [x[:300] for x in only_s]
        info["only_duck"] = [x[:300] for x in only_d]
    return info


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("names", nargs="*")
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    a = ap.parse_args()
    import __spark_entry__ as entry
    from quire.session import local_session
    spark = local_session(8, 8)
    con = duck(a.sf)
    qs, sql = entry.queries(), entry.oracle_sql()
    names = a.names or list(qs)
    bad = 0
    for n in names:
        if n not in sql:
            print({"name": n, "ok": None, "note": "no oracle"})
            continue
        try:
            info = compare(spark, con, n, qs[n], sql[n], a.sf)
        except Exception as e:  # report and go on
            info = {"name": n, "ok": False, "error": repr(e)[:800]}
        bad += not info["ok"]
        print(info, flush=True)
    print("FAILED" if bad else "ALL OK", bad)


if __name__ == "__main__":
    main()
