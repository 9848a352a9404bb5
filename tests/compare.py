"""Spark-vs-DuckDB comparison of the registered queries (local stand-in for
the driver's correctness check). Usage: python tests/compare.py [sf_dir] [name ...]"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


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
        return (2, repr(round(v, 9)))
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, (bool, int)):
        return (2, repr(float(v)) if not isinstance(v, bool) else repr(v))
    return (3, str(v))


def rows_of(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in records)


SPARK_TO_DUCK = {
    "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "float": "FLOAT", "string": "VARCHAR",
    "boolean": "BOOLEAN", "smallint": "SMALLINT", "tinyint": "TINYINT", "date": "DATE", "timestamp": "TIMESTAMP WITH TIME ZONE",
}


def compare(spark, sf_dir, name, fn, sql, con):
    t0 = time.perf_counter()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.perf_counter()
    rel = con.sql(sql)
    d_cols = [c for c in rel.columns]
    s_types = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in sdf.schema.fields}
    d_types = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    type_diff = {c: (s_types.get(c), d_types.get(c)) for c in set(s_types) | set(d_types) if s_types.get(c) != d_types.get(c)}
    d_rows = rel.fetchall()
    ok_cols = sorted(s_cols) == sorted(d_cols)
    ok_n = len(s_rows) == len(d_rows)
    ok_v = ok_cols and ok_n and rows_of(s_cols, s_rows) == rows_of(d_cols, d_rows)
    return dict(name=name, cols=ok_cols, n=ok_n, values=ok_v, types=type_diff, spark_rows=len(s_rows), duck_rows=len(d_rows),
                spark_cols=s_cols, duck_cols=d_cols, sec=round(t1 - t0, 2))


def main(argv):
    from hourglass.session import get_session
    import __spark_entry__ as E

    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if not a.startswith("/")]
    spark = get_session("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    qs, oracle = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for name, fn in qs.items():
        if names and name not in names:
            continue
        if name not in oracle:
            t0 = time.perf_counter()
            n = fn(spark, sf_dir).count()
            print(f"{name:24s} rows-only n={n} {time.perf_counter()-t0:.1f}s", flush=True)
            continue
        try:
            r = compare(spark, sf_dir, name, fn, oracle[name], con)
        except Exception as e:  # report and continue
            bad += 1
            print(f"{name:24s} ERROR {type(e).__name__}: {str(e)[:400]}", flush=True)
            continue
        flag = "OK " if r["values"] else "BAD"
        bad += 0 if r["values"] else 1
        extra = "" if r["values"] else f" cols={r['cols']} n={r['spark_rows']}/{r['duck_rows']} {r['spark_cols']} vs {r['duck_cols']}"
        types = f" TYPES {r['types']}" if r["types"] else ""
        print(f"{name:24s} {flag} rows={r['spark_rows']} {r['sec']}s{extra}{types}", flush=True)
    print("mismatches:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
