"""Run every registered query in Spark and its SQL in DuckDB, compare results.

    python tests/oracle_check.py [sf_dir] [name ...]

Rows are compared order-insensitively after sorting columns by name, the way
the driver's correctness gate does.
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
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):
            return (0, "")
        return (1, round(v, 6))
    if hasattr(v, "item"):
        v = v.item()
    return (1, v if isinstance(v, (int, str)) else str(v))


def rows_of(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in records)


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = rows_of(s_cols, [tuple(r) for r in sdf.collect()])
    t1 = time.time()
    rel = con.sql(sql)
    d_cols = list(rel.columns)
    d_rows = rows_of(d_cols, rel.fetchall())
    t2 = time.time()
    ok_cols = sorted(s_cols) == sorted(d_cols)
    ok_rows = s_rows == d_rows
    status = "OK " if (ok_cols and ok_rows) else "BAD"
    print(f"{status} {name:24s} spark={len(s_rows):7d} rows {t1 - t0:6.2f}s  "
          f"duck={len(d_rows):7d} rows {t2 - t1:6.2f}s", flush=True)
    if not ok_cols:
        print("   columns", sorted(s_cols), sorted(d_cols))
    elif not ok_rows:
        s_set, d_set = set(s_rows), set(d_rows)
        print("   only spark:", list(s_set - d_set)[:3])
        print("   only duck: ", list(d_set - s_set)[:3])
    return ok_cols and ok_rows


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    only = set(argv[2:])
    import __spark_entry__ as E
    if os.environ.get("PLAIN_SESSION"):
        # the way an outside harness builds its session: none of our defaults
        from pyspark.sql import SparkSession
        spark = (SparkSession.builder.master("local[*]")
                 .config("spark.sql.shuffle.partitions", "8").getOrCreate())
        spark.sparkContext.setLogLevel("ERROR")
        import __spark_entry__ as E2
        print("entry rows:", len(E2.entry(spark).collect()))
    else:
        from likewise.plans.session import local_session
        spark = local_session(8)
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = []
    for name, fn in qs.items():
        if only and name not in only:
            continue
        if name not in sqls:
            print(f"--- {name}: no oracle")
            continue
        if not compare(spark, con, name, fn, sqls[name], sf_dir):
            bad.append(name)
    print("FAILED:", bad if bad else "none")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
