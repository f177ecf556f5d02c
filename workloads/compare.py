"""Run queries in Spark and DuckDB side by side: ``python -m workloads.compare SF_DIR [name ...]``."""

from __future__ import annotations

import glob
import math
import os
import sys
import time
import traceback
from collections import Counter

import duckdb
from pyspark.sql import SparkSession

from workloads.oracle import ORACLE
from workloads.queries import QUERIES


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else repr(value)
    if isinstance(value, bool) or value is None:
        return value
    return str(value)


def bag(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(spark: SparkSession, con, name: str, sf_dir: str) -> tuple[bool, str]:
    start = time.time()
    df = QUERIES[name](spark, sf_dir)
    rows = df.collect()
    took = time.time() - start
    if name not in ORACLE:
        return True, f"{len(rows)} rows, no SQL, {took:.1f}s"
    result = con.execute(ORACLE[name])
    columns = [d[0] for d in result.description]
    other = result.fetchall()
    if sorted(columns) != sorted(df.columns):
        return False, f"columns differ: {sorted(set(columns) ^ set(df.columns))}"
    mine, theirs = bag(df.columns, rows), bag(columns, other)
    if mine != theirs:
        here, there = list((mine - theirs).items())[:2], list((theirs - mine).items())[:2]
        return False, f"{len(rows)} vs {len(other)} rows; Spark only {here}; SQL only {there}"
    return True, f"{len(rows)} rows, {took:.1f}s"


def main() -> None:
    sf_dir, names = sys.argv[1], sys.argv[2:] or list(QUERIES)
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name in names:
        try:
            ok, note = compare(spark, con, name, sf_dir)
        except Exception as e:  # report and go on with the next query
            ok, note = False, f"{type(e).__name__}: {str(e)[:600]}"
            if os.environ.get("TRACE"):
                traceback.print_exc()
        bad += not ok
        print("ok  " if ok else "FAIL", name, note, flush=True)
    print(f"{len(names) - bad} of {len(names)} equal")
    sys.exit(bool(bad))


if __name__ == "__main__":
    main()
