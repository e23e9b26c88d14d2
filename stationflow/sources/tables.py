"""Catalog tables of the pipeline."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..schemas import ML_SCHEMA, RAW_SCHEMA

RAW_TABLE, ML_TABLE = "raw.air_quality", "ml.air_quality_ready"
TABLES = {RAW_TABLE: RAW_SCHEMA, ML_TABLE: ML_SCHEMA}
PARTITION = "city"
_OVERWRITE = "spark.sql.sources.partitionOverwriteMode"


def _columns(schema: StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)


def create_tables(
    spark: SparkSession, tables: dict[str, StructType] = TABLES, locations: dict[str, str] | None = None
) -> None:
    """Create the schemas and tables that do not exist yet, as Parquet partitioned by city.

    A table with a location keeps its files there; the others are in the warehouse.
    """
    for name, schema in tables.items():
        if "." in name:
            spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name.split('.')[0]}")
        place = f" LOCATION '{locations[name]}'" if locations and name in locations else ""
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({_columns(schema)}) USING parquet PARTITIONED BY ({PARTITION}){place}"
        )


def check_schema(df: DataFrame, table: StructType, name: str) -> None:
    """Raise ValueError naming the columns by which ``df`` differs from the table; their order may differ."""
    has, wanted = dict(df.dtypes), {f.name: f.dataType.simpleString() for f in table}
    twice = sorted({c for c in df.columns if df.columns.count(c) > 1})
    faults = [
        *(f"{c} is missing" for c in wanted if c not in has),
        *(f"{c} is not in the table" for c in has if c not in wanted),
        *(f"{c} is {has[c]}, not {wanted[c]}" for c in wanted if c in has and has[c] != wanted[c]),
        *(f"{c} is there twice" for c in twice),
    ]
    if faults:
        raise ValueError(f"rows do not fit {name}: {', '.join(faults)}")


@contextmanager
def _dynamic_overwrite(spark: SparkSession) -> Iterator[None]:
    """Only partitions that get rows are overwritten. Writes into catalog tables read this from the session alone."""
    before = spark.conf.get(_OVERWRITE)
    spark.conf.set(_OVERWRITE, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(_OVERWRITE, before)


def replace_cities(df: DataFrame, table: str, balance: bool = True) -> None:
    """Write ``df`` into a catalog table; the cities it holds replace their rows there, other cities stay.

    Each city is replaced when the write is complete, so a failed run leaves the table as it was, and a repeated run
    gives the same table. No rows, no change. A null city is a city like any other; an empty name is stored as null.
    The rows are balanced by city first, where adaptive execution splits a large city among tasks and merges small
    ones, so that files have a sensible size; ``balance=False`` saves that exchange if the rows lie by city already.
    """
    target = df.sparkSession.table(table)
    check_schema(df, target.schema, table)
    rows = df.hint("rebalance", PARTITION) if balance else df
    with _dynamic_overwrite(df.sparkSession):
        rows.select(*[f"`{c}`" for c in target.columns]).write.mode("overwrite").insertInto(table)
