"""Runs every query in Spark and its SQL in DuckDB and compares the rows.

    python -m checks.compare [sf_dir] [query ...]
"""

import glob
import os
import sys
import tempfile
import time

import duckdb
from pyspark.sql import SparkSession

from checks.oracle import ORACLE
from checks.queries import QUERIES


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda place: columns[place])
    return sorted(tuple(repr(row[place]) for place in order) for row in rows)


def main(sf_dir="/root/testdata/sf0.01", *names):
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="clickmart-compare-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    duck = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        duck.sql(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    bad = []
    for name in names or QUERIES:
        started = time.monotonic()
        try:
            found = QUERIES[name](spark, sf_dir)
            mine = rows_of(found.columns, found.collect())
            spent = time.monotonic() - started
            sql = duck.sql(ORACLE[name])
            theirs = rows_of(sql.columns, sql.fetchall())
            ok = sorted(found.columns) == sorted(sql.columns) and mine == theirs
            print(f"{'same' if ok else 'DIFFERENT'} {name} rows={len(mine)}/{len(theirs)} {spent:.2f}s", flush=True)
            if not ok:
                print("  ", sorted(found.columns), sorted(sql.columns))
                print("   only here ", [row for row in mine if row not in set(theirs)][:2])
                print("   only there", [row for row in theirs if row not in set(mine)][:2])
        except Exception as error:
            ok = False
            print(f"FAILED {name}: {str(error)[:600]}", flush=True)
        if not ok:
            bad.append(name)
    print(f"{len(names or QUERIES) - len(bad)} same, not same: {bad}")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(*sys.argv[1:]) else 0)
