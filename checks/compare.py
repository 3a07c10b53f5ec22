"""Runs the queries next to their SQL: python -m checks.compare [folder] [query ...]"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd
from pyspark.sql import SparkSession

from checks.oracle import ORACLE
from checks.queries import QUERIES


def session(cores: int | str = 8) -> SparkSession:
    spark = (SparkSession.builder.master(f"local[{cores}]").appName("millrace")
             .config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
             .config("spark.driver.memory", "8g").config("spark.sql.session.timeZone", "UTC")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for f in sorted(Path(sf).glob("*.parquet")):
        con.execute(f"create view {f.stem} as select * from read_parquet('{f}')")
    return con


def canonical(frame: pd.DataFrame) -> pd.DataFrame:
    """Columns by name and rows by content."""
    frame = frame[sorted(frame.columns)]
    for c in frame.columns:
        if frame[c].dtype.kind == "M":
            frame = frame.assign(**{c: frame[c].astype("datetime64[us]")})
    if frame.empty:
        return frame
    return frame.sort_values(list(frame.columns), ignore_index=True)


def differences(spark, con, sf: str, name: str) -> str | None:
    """What differs between a query and its SQL; None when nothing does."""
    got = QUERIES[name](spark, sf).toArrow()
    want = con.sql(ORACLE[name]).to_arrow_table()
    kinds = [{f.name: str(f.type).replace("large_", "") for f in t.schema} for t in (got, want)]
    if kinds[0] != kinds[1]:
        return f"types {kinds[0]} and {kinds[1]}"
    a, b = (canonical(t.to_pandas()) for t in (got, want))
    if len(a) != len(b):
        return f"{len(a)} rows and {len(b)}"
    if not a.equals(b):
        wrong = [c for c in a.columns if not a[c].equals(b[c])]
        return f"values differ in {wrong}:\n{a[wrong].head()}\n{b[wrong].head()}"
    return None


if __name__ == "__main__":
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark, con = session(), connect(folder)
    bad = 0
    for name in sys.argv[2:] or QUERIES:
        start = time.time()
        try:
            found = differences(spark, con, folder, name)
        except Exception as e:
            found = f"{type(e).__name__}: {str(e)[:600]}"
        bad += found is not None
        print(f"{'ok ' if found is None else 'BAD'} {name} {time.time() - start:.1f}s {found or ''}",
              flush=True)
    print(f"{bad} bad; without SQL: {sorted(set(QUERIES) - set(ORACLE))}")
