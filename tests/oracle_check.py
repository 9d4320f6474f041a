"""Spark vs DuckDB comparison, the same shape as the driver's correctness gate.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import sys
import time

import duckdb

sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])

from __spark_entry__ import oracle_sql, queries  # noqa: E402
from tastegraph.sources.tables import TABLES  # noqa: E402


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return f"{round(v, 6):.6f}"
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(norm(x) for x in v) + "]"
    return str(v)


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], sorted(tuple(norm(r[i]) for i in order) for r in rows)


def compare(spark, sf_dir, name, con):
    q = queries()[name]
    sql = oracle_sql().get(name)
    t0 = time.time()
    df = q(spark, sf_dir)
    srows = [tuple(r) for r in df.collect()]
    st = time.time() - t0
    scols = df.columns
    if sql is None:
        return {"name": name, "status": "rows-only", "rows": len(srows), "spark_s": round(st, 2)}
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    sc, sr = canon(scols, srows)
    dc, dr = canon(dcols, drows)
    ok = sc == dc and sr == dr
    out = {"name": name, "status": "OK" if ok else "MISMATCH", "spark_rows": len(sr), "duck_rows": len(dr),
           "spark_s": round(st, 2)}
    if not ok:
        out["cols"] = (sc, dc)
        a, b = set(sr), set(dr)
        out["only_spark"] = sorted(a - b)[:5]
        out["only_duck"] = sorted(b - a)[:5]
    return out


def main():
    from tastegraph.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or sorted(queries())
    spark = build_session()
    con = duck(sf_dir)
    bad = 0
    for n in names:
        try:
            r = compare(spark, sf_dir, n, con)
        except Exception as e:  # noqa: BLE001
            r = {"name": n, "status": "ERROR", "error": repr(e)[:600]}
        bad += r["status"] in ("MISMATCH", "ERROR")
        print(r, flush=True)
    spark.stop()
    sys.exit(1 if bad else 0)


if __name__ == "__main__":
    main()
