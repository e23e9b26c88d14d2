"""Run queries in Spark and their SQL in DuckDB and compare the rows exactly."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return connection


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return repr(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(spark: SparkSession, name: str, query, sql: str, sf_dir: str, connection) -> str | None:
    """None when both sides agree, else what differs first."""
    frame = query(spark, sf_dir)
    columns, ours = _rows(frame.columns, frame.collect())
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    expected_columns, theirs = _rows(names, result.fetchall())
    if columns != expected_columns:
        return f"columns {sorted(set(columns) ^ set(expected_columns))}"
    if len(ours) != len(theirs):
        return f"{len(ours)} rows, expected {len(theirs)}"
    different = [(a, b) for a, b in zip(ours, theirs) if a != b]
    if different:
        a, b = different[0]
        cells = [(c, x, y) for c, x, y in zip(columns, a, b) if x != y]
        return f"{len(different)} rows differ, first {cells[:4]}"
    return None


if __name__ == "__main__":
    sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
    from __spark_entry__ import oracle_sql, queries

    sf_dir, only = sys.argv[1], sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection, oracles = duck(sf_dir), oracle_sql()
    for name, query in queries().items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            if name in oracles:
                verdict = compare(spark, name, query, oracles[name], sf_dir, connection) or "ok"
            else:
                verdict = f"rows {query(spark, sf_dir).count()}"
        except Exception as error:  # report and go on with the other queries
            verdict = f"ERROR {type(error).__name__} {str(error)[:600]}"
        print(f"{name:28s} {time.time() - start:6.2f}s {verdict}", flush=True)
