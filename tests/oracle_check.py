"""Run registered queries in Spark and their oracle SQL in DuckDB, compare.

Usage: python tests/oracle_check.py [sf_dir] [name ...]

Comparison: same row count, same column names, and the same multiset of rows
(columns sorted by name; doubles compared to 1e-9 relative).
"""

from __future__ import annotations

import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str):
    import duckdb
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
        return (2, round(v, 9))
    if hasattr(v, "item"):
        v = v.item()
        return _norm(v)
    return (3, str(v))


def rows_of_spark(df):
    cols = sorted(df.columns)
    return cols, sorted(tuple(_norm(r[c]) for c in cols) for r in df.select(*cols).collect())


def rows_of_duck(con, sql):
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    data = rel.fetchall()
    cols = sorted(names)
    ix = [names.index(c) for c in cols]
    return cols, sorted(tuple(_norm(r[i]) for i in ix) for r in data)


SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
                 "float": "FLOAT", "boolean": "BOOLEAN", "smallint": "SMALLINT"}


def spark_types(df):
    return {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
            for f in df.schema.fields}


def duck_types(con, sql):
    rel = con.sql(sql)
    return {n: str(t) for n, t in zip(rel.columns, rel.types)}


def compare(spark, con, sf_dir, name, fn, sql):
    t = time.time()
    df = fn(spark, sf_dir)
    st = spark_types(df)
    sc, sr = rows_of_spark(df)
    ts = time.time() - t
    t = time.time()
    dc, dr = rows_of_duck(con, sql)
    dt = duck_types(con, sql)
    td = time.time() - t
    ok = sc == dc and len(sr) == len(dr) and sr == dr and st == dt
    detail = ""
    if not ok:
        if st != dt and sc == dc:
            detail = f"types spark={st} duck={dt}"
        elif sc != dc:
            detail = f"columns spark={sc} duck={dc}"
        elif len(sr) != len(dr):
            detail = f"rows spark={len(sr)} duck={len(dr)}"
        else:
            diff = [(a, b) for a, b in zip(sr, dr) if a != b][:3]
            detail = f"first diffs {diff}"
    return ok, len(sr), ts, td, detail


def main(argv):
    from dwellrec.session import build_session
    import __spark_entry__ as E
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    only = set(argv[1:])
    spark = build_session("local[8]", shuffle_partitions=8)
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if only and name not in only:
            continue
        if name not in sqls:
            t = time.time()
            n = fn(spark, sf_dir).count()
            print(f"ROWS  {name:28s} rows={n} spark={time.time() - t:.1f}s", flush=True)
            continue
        ok, n, ts, td, detail = compare(spark, con, sf_dir, name, fn, sqls[name])
        bad += not ok
        print(f"{'OK  ' if ok else 'FAIL'}  {name:28s} rows={n} spark={ts:.1f}s duck={td:.1f}s {detail}",
              flush=True)
    print("failures:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
