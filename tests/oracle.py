"""Runs queries and their SQL side by side.

As a script: ``python tests/oracle.py [sf] [query ...]``.
"""

from __future__ import annotations

import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def sf_dir(sf: str) -> str:
    return f"/root/testdata/sf{sf}"


def connect(directory: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{directory}/{name}.parquet')")
    return con


def compare(df, con, sql: str) -> str | None:
    """None if names, types and rows are the same, otherwise what differs."""
    got_names = df.columns
    cursor = con.execute(sql)
    want_names = [d[0] for d in cursor.description]
    want = cursor.fetchall()
    if sorted(got_names) != sorted(want_names):
        return f"columns {sorted(got_names)} != {sorted(want_names)}"
    got = [tuple(row) for row in df.collect()]
    order = sorted(got_names)
    got_rows = Counter(tuple(repr(r[got_names.index(c)]) for c in order) for r in got)
    want_rows = Counter(tuple(repr(r[want_names.index(c)]) for c in order) for r in want)
    if got_rows != want_rows:
        extra, lost = list((got_rows - want_rows).items())[:3], list((want_rows - got_rows).items())[:3]
        return f"{len(got)} rows, want {len(want)}; {order}\n   only spark: {extra}\n   only sql: {lost}"
    return None


def main() -> int:
    from pyspark.sql import SparkSession

    from __spark_entry__ import oracle_sql, queries

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    names = sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", os.environ.get("ORACLE_TZ", "UTC"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, bad = connect(sf_dir(sf)), oracle_sql(), 0
    for name, query in queries().items():
        if names and name not in names:
            continue
        begun = time.time()
        try:
            df = query(spark, sf_dir(sf))
            if name in sqls:
                problem, note = compare(df, con, sqls[name]), ""
            else:
                problem, note = None, f" ({df.count()} rows, no sql)"
        except Exception as error:
            problem, note = f"{type(error).__name__}: {str(error)[:1500]}", ""
        bad += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - begun:.2f}s{note}", flush=True)
        if problem:
            print("   ", problem, flush=True)
    print(f"{bad} failed")
    return bad


if __name__ == "__main__":
    sys.exit(main())
