"""Run registered queries in Spark and their oracles in DuckDB and compare.

``python -m tests.oracle [key ...]`` prints one line per key; ``SF`` picks the folder.
"""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb
from pyspark.sql import SparkSession

from minewright.registry import load_all

SF = os.environ.get("SF", "/root/testdata/sf0.01")


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{os.environ.get('BENCH_CPUS', '8')}]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def duck(folder: str = SF) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _cell(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(_cell(row[i]) for i in order) for row in rows]
    return sorted(names), sorted(out, key=lambda r: tuple((v is None, str(type(v)), str(v)) for v in r))


def compare(spark, con, plan, folder: str = SF):
    """Return (ok, message)."""
    started = time.time()
    df = plan(spark, folder)
    got_names, got = _rows(df.columns, [tuple(r) for r in df.collect()])
    spark_time = time.time() - started
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    if plan.oracle is None:
        return bool(got), f"{len(got)} rows, no oracle ({spark_time:.1f}s)"
    started = time.time()
    result = con.execute(plan.oracle)
    want_names, want = _rows([d[0] for d in result.description], result.fetchall())
    duck_time = time.time() - started
    note = f"{len(got)} rows spark {spark_time:.1f}s duck {duck_time:.1f}s"
    if got_names != want_names:
        return False, f"columns {got_names} != {want_names}"
    if len(got) != len(want):
        return False, f"row count {len(got)} != {len(want)}; {got[:2]} / {want[:2]}"
    for left, right in zip(got, want):
        if left != right:
            return False, f"{note}\n   first difference\n   spark {left}\n   duck  {right}"
        if [type(v) for v in left] != [type(v) for v in right]:
            return False, f"{note} types {left} / {right} {types}"
    if not got:
        return False, "no rows"
    return True, note


def main(keys):
    spark, con, plans = session(), duck(), load_all()
    bad = 0
    for key in keys or plans:
        try:
            ok, message = compare(spark, con, plans[key])
        except Exception as error:  # report and go on with the next key
            ok, message = False, f"{type(error).__name__}: {str(error)[:1500]}"
        bad += not ok
        print(("ok  " if ok else "BAD ") + key + ": " + message, flush=True)
    print(f"{bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(bool(main(sys.argv[1:])))
