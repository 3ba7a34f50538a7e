"""Run registered queries next to their SQL in DuckDB and compare the results.

python tests/oracle_check.py [folder] [query ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb
from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as spark_entry  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


# DuckDB type of each Spark type that the results use.
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
}


def _cell(value: object) -> object:
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.10g}")
    return value


def _sorted_rows(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_cell(r[i]) for i in order) for r in rows), key=repr)


def compare(df: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when columns and rows agree, else what differs first."""
    expected = connection.execute(sql)
    names = [d[0] for d in expected.description]
    rows = _sorted_rows(names, expected.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} instead of {sorted(names)}"
    kinds = {d[0]: str(d[1]) for d in expected.description}
    for field in df.schema.fields:
        if TYPES.get(field.dataType.simpleString()) != kinds[field.name]:
            return f"{field.name} is {field.dataType.simpleString()}, expected {kinds[field.name]}"
    actual = _sorted_rows(df.columns, [tuple(r) for r in df.collect()])
    if len(actual) != len(rows):
        return f"{len(actual)} rows instead of {len(rows)}"
    for got, want in zip(actual, rows, strict=True):
        if got != want:
            return f"got {str(got)[:600]}\n    want {str(want)[:600]}"
    return None


def main() -> int:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(folder)
    oracles = spark_entry.oracle_sql()
    bad = 0
    for name, run in spark_entry.queries().items():
        if chosen and name not in chosen:
            continue
        start = time.time()
        try:
            df = run(spark, folder)
            problem = compare(df, connection, oracles[name]) if name in oracles else None
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - start:.2f}s", flush=True)
        if problem:
            print(f"    {problem}", flush=True)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
