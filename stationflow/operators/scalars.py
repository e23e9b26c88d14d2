"""One-row statistics next to every row, without a join."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def with_scalars(df: DataFrame, stats: DataFrame, name: str = "_stats") -> DataFrame:
    """Add the single row of ``stats`` as one struct column, through a scalar subquery.

    The statistics stay part of the query and reach the tasks as a constant.
    """
    return df.withColumn(name, stats.select(F.struct(*[F.col(c) for c in stats.columns])).scalar())


def one_row(spark: SparkSession, values: dict[str, object], schema: StructType) -> DataFrame:
    """A frame of one row of constants, which the optimizer folds into the queries that use it."""
    return spark.sql("SELECT 1").select(*[F.lit(values[f.name]).cast(f.dataType).alias(f.name) for f in schema])


def evaluated(stats: DataFrame) -> DataFrame:
    """The same single row, computed now, for statistics that several jobs need."""
    return one_row(stats.sparkSession, stats.first().asDict(), stats.schema)
