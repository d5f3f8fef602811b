"""Side-by-side run of the named queries: Spark against DuckDB on the same parquet files."""

from __future__ import annotations

import datetime as dt
import decimal
import os
import sys
import tempfile
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def session(cores: int = 8):
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("millrace-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tests-"))
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.autoBroadcastJoinThreshold", os.environ.get("BROADCAST_LIMIT", "10MB"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        return ("num", float(value))
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, int):
        return ("int", value)
    if isinstance(value, float):
        return ("num", 0.0 if value == 0 else value) if value == value else ("num", "nan")
    if isinstance(value, dt.datetime):
        return ("ts", value.replace(tzinfo=None).isoformat())
    if isinstance(value, dt.date):
        return ("date", value.isoformat())
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, build, oracle, sf_dir: str) -> str:
    """Empty text when both sides agree, else a short account of the difference."""
    df = build(spark, sf_dir)
    ours = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if oracle is None:
        return "" if ours else "no rows"
    cur = con.execute(oracle)
    names = [d[0] for d in cur.description]
    theirs = rows_of(names, cur.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns differ: {sorted(df.columns)} / {sorted(names)}"
    if not ours:
        return "both sides empty" if not theirs else "no rows from Spark"
    if ours == theirs:
        return ""
    left, right = set(ours), set(theirs)
    extra, missing = sorted(left - right, key=repr)[:2], sorted(right - left, key=repr)[:2]
    return f"{len(ours)} rows against {len(theirs)}; only Spark {extra}; only SQL {missing}"


if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from millrace.plans import QUERIES

    sf = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    masks = sys.argv[1:]
    spark, con, bad = session(), connect(sf), 0
    for name, q in QUERIES.items():
        if masks and not any(m in name for m in masks):
            continue
        start = time.time()
        try:
            note = compare(spark, con, q.build, q.oracle, sf)
        except Exception as error:  # report and go on with the next query
            note = f"{type(error).__name__}: {str(error)[:700]}"
        bad += bool(note)
        print(f"{'FAIL' if note else 'ok  '} {name} {time.time() - start:.1f}s {note}", flush=True)
    print(f"{bad} failing")
