"""Run every registered query against its SQL twin: python tests/check_queries.py [sf] [name...]."""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(cell(row[i]) for i in order) for row in rows]
    return sorted(out, key=repr)


def compare(spark, name, query, sql, sf_dir):
    df = query(spark, sf_dir)
    got = rows_of(df.columns, [tuple(row) for row in df.collect()])
    if sql is None:
        return "rows-only", len(got), ""
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    cur = con.execute(sql)
    cols = [c[0] for c in cur.description]
    want = rows_of(cols, cur.fetchall())
    if sorted(cols) != sorted(df.columns):
        return "COLUMNS", len(got), f"{sorted(df.columns)} vs {sorted(cols)}"
    if len(got) != len(want):
        return "COUNT", len(got), f"{len(got)} vs {len(want)}"
    bad = [(a, b) for a, b in zip(got, want) if a != b]
    if bad:
        return "VALUES", len(got), f"{len(bad)} rows differ, e.g. {bad[0][0]} vs {bad[0][1]}"
    return "ok", len(got), ""


def main():
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf = sys.argv[1] if len(sys.argv) > 1 else "sf0.01"
    names = sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    queries, oracles = entry.queries(), entry.oracle_sql()
    tally = {}
    for name, q in queries.items():
        if names and not any(name.startswith(n) for n in names):
            continue
        t = time.time()
        try:
            status, n, note = compare(spark, name, q, oracles.get(name), f"/root/testdata/{sf}")
        except Exception as e:  # report and go on
            status, n, note = "ERROR", 0, f"{type(e).__name__}: {str(e)[:600]}"
        tally[status] = tally.get(status, 0) + 1
        print(f"{status:9s} {time.time() - t:6.1f}s {n:7d} {name} {note}", flush=True)
    print(tally)


if __name__ == "__main__":
    main()
