"""Compares a Spark query with its DuckDB twin, as the driver does: names sorted, rows without order."""

import math
import sys

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
SF = "/root/testdata/sf0.001"


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


def duck(sql, sf=SF):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    cur = con.execute(sql)
    return rows_of([d[0] for d in cur.description], cur.fetchall())


def compare(spark, name, f, sql, sf=SF):
    df = f(spark, sf)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    want = duck(sql, sf)
    assert got[0] == want[0], (name, got[0], want[0])
    assert len(got[1]) == len(want[1]), (name, len(got[1]), len(want[1]))
    bad = [(a, b) for a, b in zip(got[1], want[1]) if a != b]
    assert not bad, (name, len(bad), bad[:3])
    return len(got[1])


if __name__ == "__main__":
    import os
    import time

    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as e
    from pyspark.sql import SparkSession

    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC")
             .config("spark.driver.memory", "8g").config("spark.ui.showConsoleProgress", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    sf = sys.argv[1]
    q, o = e.queries(), e.oracle_sql()
    for n in sys.argv[2:] or list(q):
        t = time.time()
        try:
            if n in o:
                k = compare(spark, n, q[n], o[n], sf)
            else:
                df = q[n](spark, sf)
                df.show(3, 60)
                k = df.count()
            print(f"ok   {n} {k} rows {time.time() - t:.1f}s", "" if n in o else "(no SQL twin)", flush=True)
        except Exception as x:
            print(f"FAIL {n} {time.time() - t:.1f}s {str(x)[:1500]}", flush=True)
