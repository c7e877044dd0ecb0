"""Run queries() against oracle_sql() on the same parquet tables and compare
row count, column names and the order-insensitive multiset of values.

    python tests/oracle_harness.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from valorem.sources.tables import TABLES  # noqa: E402


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):
            return (1, "nan")
        return (2, repr(float(v)))
    if isinstance(v, bool):
        return (3, str(int(v)))
    if isinstance(v, int):
        return (4, str(v))
    if hasattr(v, "isoformat"):
        return (5, v.isoformat(sep=" "))
    if isinstance(v, (list, tuple)):
        return (6, repr([_norm(x) for x in v]))
    return (7, str(v))


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    out.sort()
    return [names[i] for i in order], out


def compare(spark, con, name: str, fn, sql: str, sf_dir: str) -> dict:
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    rel = con.sql(sql)
    dnames = list(rel.columns)
    dtypes = [str(t) for t in rel.types]
    drows = rel.fetchall()
    t2 = time.time()
    sn, sr = _rows(sdf.columns, srows)
    dn, dr = _rows(dnames, drows)
    smap = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
            "boolean": "BOOLEAN", "float": "FLOAT", "smallint": "SMALLINT", "timestamp": "TIMESTAMP WITH TIME ZONE",
            "timestamp_ntz": "TIMESTAMP"}
    st = {n: smap.get(t, t) for n, t in sdf.dtypes}
    dt = dict(zip(dnames, dtypes))
    type_diff = {n: (st.get(n), dt.get(n)) for n in dt if st.get(n) != dt.get(n)}
    res = {"name": name, "types_match": not type_diff, "spark_rows": len(sr), "oracle_rows": len(dr), "names_match": sn == dn,
           "values_match": sr == dr, "spark_s": round(t1 - t0, 2), "oracle_s": round(t2 - t1, 2)}
    if type_diff:
        res["type_diff"] = type_diff
    if not res["names_match"]:
        res["spark_names"], res["oracle_names"] = sn, dn
    elif not res["values_match"]:
        diff_s = [r for r in sr if r not in set(dr)][:3]
        diff_d = [r for r in dr if r not in set(sr)][:3]
        res["spark_only"], res["oracle_only"] = diff_s, diff_d
    return res


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    only = [a for a in argv[1:] if not a.startswith("/")]
    import __spark_entry__ as E
    from valorem.session import local_session
    spark = local_session(8)
    con = duck(sf_dir)
    qs, ors = E.queries(), E.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if only and name not in only:
            continue
        if name not in ors:
            t0 = time.time()
            n = fn(spark, sf_dir).count()
            print({"name": name, "rows_only": n, "spark_s": round(time.time() - t0, 2)}, flush=True)
            continue
        try:
            r = compare(spark, con, name, fn, ors[name], sf_dir)
        except Exception as e:  # report and continue
            r = {"name": name, "error": repr(e)[:800]}
        ok = r.get("names_match") and r.get("values_match") and r.get("spark_rows") == r.get("oracle_rows")
        bad += 0 if ok else 1
        print(("OK  " if ok else "BAD ") + str(r), flush=True)
    print(f"mismatches: {bad}")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
