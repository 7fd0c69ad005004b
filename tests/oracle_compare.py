"""Run ``queries()`` in Spark and ``oracle_sql()`` in DuckDB and compare.

Order-insensitive: both sides are turned into sorted lists of row tuples after
sorting columns by name.  Types are compared through a small Spark -> DuckDB
type map.  Usable as a script: ``python tests/oracle_compare.py [sf_dir] [key ...]``.
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()

_TYPES = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
          "date": "DATE", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return ("nan",)
        return v
    return v


def _key(row):
    return tuple((v is None, str(type(v)), v if v is not None else 0) for v in row)


def canon(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return [names[i] for i in order], sorted(out, key=_key)


def compare_one(spark, con, sf_dir, key, build, sql):
    t0 = time.time()
    sdf = build(spark, sf_dir)
    s_rows = [tuple(r) for r in sdf.collect()]
    t_spark = time.time() - t0
    s_types = [f.dataType.simpleString() for f in sdf.schema.fields]
    rel = con.sql(sql)
    d_names = rel.columns
    d_types = [str(t) for t in rel.types]
    d_rows = rel.fetchall()
    res = {"key": key, "spark_rows": len(s_rows), "oracle_rows": len(d_rows), "spark_sec": round(t_spark, 2)}
    sn, sr = canon(sdf.columns, s_rows)
    dn, dr = canon(d_names, d_rows)
    res["names_match"] = sn == dn
    st = dict(zip(sdf.columns, s_types))
    dt = dict(zip(d_names, d_types))
    res["types_match"] = all(_TYPES.get(st.get(c), st.get(c)) == dt.get(c) for c in sn) and sn == dn
    res["values_match"] = sr == dr
    if not res["values_match"] and len(sr) == len(dr):
        diff = [(a, b) for a, b in zip(sr, dr) if a != b][:3]
        res["first_diffs"] = diff
    if not res["names_match"]:
        res["names"] = (sn, dn)
    if not res["types_match"]:
        res["types"] = (st, dt)
    res["ok"] = res["names_match"] and res["types_match"] and res["values_match"]
    return res


def compare(spark, sf_dir, keys=None):
    import __spark_entry__ as E
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    out = []
    for k in keys or list(qs):
        if k not in sqls:
            out.append({"key": k, "ok": None, "note": "no oracle"})
            continue
        try:
            out.append(compare_one(spark, con, sf_dir, k, qs[k], sqls[k]))
        except Exception as e:  # report and continue with the next key
            out.append({"key": k, "ok": False, "error": f"{type(e).__name__}: {str(e)[:400]}"})
    return out


if __name__ == "__main__":
    from tallycast.plans.session import local_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    keys = sys.argv[2:] or None
    spark = local_session(8)
    for r in compare(spark, sf, keys):
        print(r, flush=True)
