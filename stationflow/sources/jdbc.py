"""Relational databases over JDBC."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

BATCH_ROWS = 10_000


def connection_properties() -> dict[str, str]:
    """URL, user, password and driver from the environment; there is no default password."""
    missing = [v for v in ("POSTGRES_URL", "POSTGRES_USER", "POSTGRES_PASSWORD") if not os.getenv(v)]
    if missing:
        raise ValueError(f"set {', '.join(missing)}")
    return {
        "url": os.environ["POSTGRES_URL"],
        "user": os.environ["POSTGRES_USER"],
        "password": os.environ["POSTGRES_PASSWORD"],
        "driver": os.getenv("JDBC_DRIVER", "org.postgresql.Driver"),
    }


def read_options(
    table: str,
    properties: dict[str, str],
    partition_column: str | None = None,
    lower: object = None,
    upper: object = None,
    partitions: int = 1,
    fetch_rows: int = BATCH_ROWS,
) -> dict[str, str]:
    options = {**properties, "dbtable": table, "fetchsize": str(fetch_rows)}
    if partition_column is not None:
        if lower is None or upper is None:
            raise ValueError("a partitioned read needs both bounds")
        options |= {
            "partitionColumn": partition_column,
            "lowerBound": str(lower),
            "upperBound": str(upper),
            "numPartitions": str(partitions),
        }
    return options


def write_options(
    table: str, properties: dict[str, str], batch_rows: int = BATCH_ROWS, truncate: bool = True,
    connections: int | None = None,
) -> dict[str, str]:
    options = {**properties, "dbtable": table, "batchsize": str(batch_rows), "truncate": str(truncate).lower()}
    return options if connections is None else {**options, "numPartitions": str(connections)}


def read_jdbc(spark: SparkSession, table: str, properties: dict[str, str], **partitioning) -> DataFrame:
    """A table; with a partition column and its bounds, read over several connections at once.

    The bounds only divide the work: rows outside them are read too.
    """
    return spark.read.format("jdbc").options(**read_options(table, properties, **partitioning)).load()


def write_jdbc(df: DataFrame, table: str, properties: dict[str, str], mode: str = "overwrite", **tuning) -> None:
    """Batched inserts. Overwriting empties the table rather than dropping it, so its types and indexes stay."""
    df.write.format("jdbc").mode(mode).options(**write_options(table, properties, **tuning)).save()
