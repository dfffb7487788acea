"""Run every registered query beside its SQL twin and report differences.

    python -m checks.compare /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import glob
import os
import sys
import tempfile
import time

import duckdb
import pandas as pd
from pyspark.sql import SparkSession

from checks.registry import ORACLES, QUERIES


def session() -> SparkSession:
    return (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", f"file://{tempfile.mkdtemp(prefix='advertlake-compare-')}")
        .getOrCreate()
    )


def rows_of(pdf) -> list[tuple]:
    names = sorted(pdf.columns)

    def text(v) -> str:
        if v is None or v is pd.NA or v != v:
            return "NULL"
        if isinstance(v, bool) or type(v).__name__ in ("bool", "bool_"):
            return str(bool(v))
        if isinstance(v, (int, float)) or hasattr(v, "dtype"):
            return repr(float(v))
        return str(v)

    return sorted(tuple(text(v) for v in row) for row in pdf[names].itertuples(index=False, name=None))


def main(sf_dir: str, names: list[str]) -> int:
    spark = session()
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    bad = 0
    for name in names or list(QUERIES):
        start = time.time()
        try:
            got = QUERIES[name](spark, sf_dir).toPandas()
        except Exception as error:
            bad += 1
            print(f"ERROR {name}: {str(error)[:1500]}", flush=True)
            continue
        took = time.time() - start
        if name not in ORACLES:
            print(f"rows  {name} {len(got)} {took:.1f}s", flush=True)
            continue
        start = time.time()
        try:
            want = con.execute(ORACLES[name]).df()
        except Exception as error:
            bad += 1
            print(f"SQL   {name}: {str(error)[:1500]}", flush=True)
            continue
        sql_took = time.time() - start
        if sorted(got.columns) != sorted(want.columns):
            bad += 1
            print(f"COLS  {name}: {sorted(got.columns)} != {sorted(want.columns)}", flush=True)
            continue
        a, b = rows_of(got), rows_of(want)
        if a == b:
            print(f"ok    {name} {len(a)} rows {took:.1f}s (sql {sql_took:.1f}s)", flush=True)
        else:
            bad += 1
            left, right = sorted(set(a) - set(b)), sorted(set(b) - set(a))
            print(f"DIFF  {name}: {len(a)} vs {len(b)} rows; {len(left)} only here, {len(right)} only there", flush=True)
            for x in left[:2]:
                print("   here ", str(x)[:700])
            for x in right[:2]:
                print("   there", str(x)[:700])
    print(f"{bad} of {len(names or QUERIES)} queries differ")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
