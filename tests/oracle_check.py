"""Run registered queries in Spark and their SQL in DuckDB and compare whole results.

Usage: python tests/oracle_check.py [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return con


def _cell(value: object) -> object:
    if value is None or value is pd.NaT or value is pd.NA:
        return None
    if isinstance(value, float):
        return None if math.isnan(value) else repr(value)
    if hasattr(value, "item"):
        return _cell(value.item())
    return repr(float(value)) if isinstance(value, int) and not isinstance(value, bool) else value


def rows_of(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_cell(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, sf_dir: str, query, sql: str) -> str | None:
    df = query(spark, sf_dir)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    expected = rows_of(names, result.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if len(got) != len(expected):
        return f"rows {len(got)} != {len(expected)}"
    for g, e in zip(got, expected):
        if g != e:
            return f"{str(g)[:600]}\n   != {str(e)[:600]}"
    return None


def main() -> int:
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    sql = entry.oracle_sql()
    bad = 0
    for name, query in entry.queries().items():
        if sys.argv[2:] and name not in sys.argv[2:] or name not in sql:
            continue
        began = time.perf_counter()
        try:
            problem = compare(spark, con, sf_dir, query, sql[name])
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += problem is not None
        print(f"{name:24} {'ok' if problem is None else 'BAD'} {time.perf_counter() - began:6.2f}s", flush=True)
        if problem:
            print("  ", problem, flush=True)
    print("bad:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main())
