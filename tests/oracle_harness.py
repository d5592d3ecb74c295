"""Run registered queries in Spark and their oracle SQL in DuckDB and compare.

Comparison is strict: same column names, same row count, and the same
multiset of rows after normalising values (Decimal -> float, dates/timestamps
-> ISO text).  Usage: ``python tests/oracle_harness.py [sf_dir] [key ...]``.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, os.path.dirname(HERE))

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(root: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{root}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"create view {t} as select * from read_parquet('{p}')")
    return con


def norm(v):
    if v is None:
        return None
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, float):
        return None if math.isnan(v) else float(v)
    if isinstance(v, bool):
        return v
    if isinstance(v, int):
        return float(v)
    if isinstance(v, dt.datetime):
        return v.isoformat(sep=" ")
    if isinstance(v, dt.date):
        return dt.datetime(v.year, v.month, v.day).isoformat(sep=" ")
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


SPARK_FAMILY = {"IntegerType": "int32", "LongType": "int64", "DoubleType": "double", "StringType": "string",
                "DateType": "date", "TimestampNTZType": "timestamp", "TimestampType": "timestamp",
                "BooleanType": "bool"}
DUCK_FAMILY = {"INTEGER": "int32", "BIGINT": "int64", "DOUBLE": "double", "VARCHAR": "string", "DATE": "date",
               "TIMESTAMP": "timestamp", "BOOLEAN": "bool"}


def type_mismatches(sdf, con, sql):
    """Columns whose type family differs between the Spark result and the SQL."""
    st = {f.name: SPARK_FAMILY.get(type(f.dataType).__name__, str(f.dataType)) for f in sdf.schema.fields}
    rel = con.sql(sql)
    dt = {n: DUCK_FAMILY.get(str(t), str(t)) for n, t in zip(rel.columns, rel.types)}
    return {c: (st.get(c), dt.get(c)) for c in set(st) | set(dt) if st.get(c) != dt.get(c)}


def canon(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(norm(r[i]) for i in order) for r in rows]
    return [names[i] for i in order], sorted(out, key=repr)


def compare(spark, con, key, fn, sql, root):
    t0 = time.time()
    sdf = fn(spark, root)
    srows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    snames = sdf.columns
    res = con.execute(sql)
    dnames = [d[0] for d in res.description]
    drows = res.fetchall()
    t2 = time.time()
    sn, sr = canon(snames, srows)
    dn, dr = canon(dnames, drows)
    problems = []
    if sn != dn:
        problems.append(f"columns spark={sn} duck={dn}")
    if len(sr) != len(dr):
        problems.append(f"rows spark={len(sr)} duck={len(dr)}")
    elif sr != dr:
        bad = [(a, b) for a, b in zip(sr, dr) if a != b][:3]
        problems.append(f"values differ, e.g. {bad}")
    return problems, len(srows), t1 - t0, t2 - t1


def main(argv):
    root = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    only = set(argv[2:])
    from tillroll.session import build_session
    import __spark_entry__ as entry
    spark = build_session("local[8]", shuffle_partitions=8)
    qs, oracle = entry.queries(), entry.oracle_sql()
    con = duck(root)
    failed = 0
    for key in sorted(qs):
        if only and key not in only:
            continue
        if key not in oracle:
            n = qs[key](spark, root).count()
            print(f"{key:40s} NO-ORACLE rows={n}")
            continue
        try:
            problems, n, ts, td = compare(spark, con, key, qs[key], oracle[key], root)
        except Exception as e:  # report and continue
            problems, n, ts, td = [f"error {type(e).__name__}: {str(e)[:400]}"], -1, 0, 0
        status = "OK" if not problems else "FAIL"
        failed += bool(problems)
        print(f"{key:40s} {status} rows={n} spark={ts:.2f}s duck={td:.2f}s {' | '.join(problems)}")
    print(f"failed={failed}")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
