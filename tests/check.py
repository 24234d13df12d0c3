"""Compare registered queries with their SQL: ``python tests/check.py FOLDER [NAME ...]``."""

from __future__ import annotations

import datetime
import decimal
import glob
import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def normal(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6) + 0.0
    if isinstance(value, datetime.datetime) or type(value).__name__ == "Timestamp":
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, datetime.date):
        return value.isoformat()
    return value


def rows_of(names, records):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(
        (tuple(normal(record[i]) for i in order) for record in records), key=repr)


def connect(folder):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def compare(spark, con, folder, name, run, sql):
    """Empty text if both engines agree, else what differs."""
    df = run(spark, folder)
    got_names, got = rows_of(df.columns, [tuple(row) for row in df.collect()])
    result = con.execute(sql)
    want_names, want = rows_of([column[0] for column in result.description], result.fetchall())
    if got_names != want_names:
        return f"columns {got_names} != {want_names}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    if not got:
        return "no rows"
    for left, right in zip(got, want):
        if left != right:
            return f"{left} != {right}"
    return ""


def main(folder, only):
    import __spark_entry__ as entry
    from candlelake.session import build_session

    spark = build_session(master="local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    failed = 0
    for name, run in entry.queries().items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            sql = entry.oracle_sql().get(name)
            problem = compare(spark, con, folder, name, run, sql) if sql else f"no SQL; {run(spark, folder).count()} rows"
        except Exception as error:  # report every failing query, not just the first
            problem = f"{type(error).__name__}: {str(error)[:400]}"
        failed += bool(problem) and not problem.startswith("no SQL")
        print(f"{name:32} {time.time() - start:6.2f}s {problem or 'ok'}", flush=True)
    print(f"{failed} failed")


if __name__ == "__main__":
    main(sys.argv[1], set(sys.argv[2:]))
