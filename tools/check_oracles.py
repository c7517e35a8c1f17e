"""Run registered queries next to their SQL and compare. Usage: check_oracles.py [sf_dir] [key ...]"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb
from pyspark.sql import SparkSession

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def session(cpus: str = "8") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted([tuple(_plain(r[i]) for i in order) for r in rows], key=repr)


def compare(spark, con, key, fn, sql, folder):
    start = time.time()
    frame = fn(spark, folder)
    got = rows_of(frame.columns, [tuple(r) for r in frame.collect()])
    took = time.time() - start
    if sql is None:
        return True, f"{len(got[1])} rows, no SQL", took
    start = time.time()
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = rows_of(names, cur.fetchall())
    sql_time = time.time() - start
    types = {f.name: f.dataType.simpleString() for f in frame.schema}
    if got == want:
        return True, f"{len(got[1])} rows, sql {sql_time:.1f}s", took
    if got[0] != want[0]:
        return False, f"columns {got[0]} vs {want[0]}", took
    diff = [(g, w) for g, w in zip(got[1], want[1]) if g != w][:2]
    return False, f"{len(got[1])} vs {len(want[1])} rows; {types}; first {diff}", took


def main() -> None:
    from tallyloom.catalog import ORACLES, QUERIES

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark, con = session(), connect(folder)
    bad = 0
    for key, fn in QUERIES.items():
        if wanted and not any(key == w or (w.endswith("*") and key.startswith(w[:-1])) for w in wanted):
            continue
        try:
            ok, note, took = compare(spark, con, key, fn, ORACLES.get(key), folder)
        except Exception as exc:  # report and go on with the next query
            ok, note, took = False, f"{type(exc).__name__}: {str(exc)[:700]}", 0.0
        bad += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {key:12s} {took:6.1f}s {note}", flush=True)
    print(f"{bad} failed")
    spark.stop()


if __name__ == "__main__":
    main()
