"""City summaries of a stored dataset, kept up as part files come.

Sums and counts of each (city, part file) are stored; they merge by addition, so a new part is read once and no other part
is read again. States of parts that the dataset no longer has do not count.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import half_up
from ..operators.summary import CITY_MEANS
from ..sources import read_dataset

PART = "part"
_COLUMNS = list(CITY_MEANS.values())
_SCHEMA = f"{PART} string, city string, " + ", ".join(f"{c}_sum double, {c}_n bigint" for c in _COLUMNS)


def part_states(dataset: DataFrame) -> DataFrame:
    """Sum and count of each measure per (part file, city); NaN and null add nothing to either."""
    number = {c: F.nanvl(F.col(c).cast("double"), F.lit(None)) for c in _COLUMNS}
    sums = [a for c, x in number.items() for a in (F.sum(x).alias(f"{c}_sum"), F.count(x).alias(f"{c}_n"))]
    return dataset.groupBy(F.input_file_name().alias(PART), "city").agg(*sums)


def _stored(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.schema(_SCHEMA).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _SCHEMA)


def _present(dataset: DataFrame, states: DataFrame) -> tuple[list[str], DataFrame]:
    """The dataset's part files without a state, and the states of those it has."""
    files = dataset.inputFiles()  # names alone: as many as there are files
    spark = dataset.sparkSession
    listed = spark.createDataFrame([(f,) for f in files], f"{PART} string")
    known = {r[0] for r in states.select(PART).distinct().join(listed, PART, "left_semi").collect()}
    return [f for f in files if f not in known], states.join(listed, PART, "left_semi")


def update_summary(spark: SparkSession, dataset_path: str, state_path: str) -> int:
    """Add the states of new part files of the dataset; returns how many were read. An absent dataset is an error."""
    dataset = read_dataset(spark, dataset_path)
    new, _ = _present(dataset, _stored(spark, state_path))
    if new:
        form = "csv" if any(".csv" in f for f in new) else "parquet"
        reader = spark.read.schema(dataset.schema).option("header", True)
        # Empty files have no rows and so no state; a marker row keeps them from being read again.
        states = part_states(reader.format(form).load(new))
        marks = spark.createDataFrame([(f,) for f in new], f"{PART} string")
        states.unionByName(marks, allowMissingColumns=True).write.mode("append").parquet(state_path)
    return len(new)


def stored_summary(spark: SparkSession, dataset_path: str, state_path: str) -> DataFrame:
    """The summary of the dataset as it is now, from its states; see :func:`stationflow.operators.summary.city_summary`."""
    update_summary(spark, dataset_path, state_path)
    _, states = _present(read_dataset(spark, dataset_path), _stored(spark, state_path))
    means = []
    for name, c in CITY_MEANS.items():
        n = F.sum(f"{c}_n")
        means.append(half_up(F.when(n > 0, F.sum(f"{c}_sum") / n), 2).alias(name))
    return (
        states.filter(F.col("city").isNotNull())
        .groupBy("city")
        .agg(*means, F.sum(f"{CITY_MEANS['avg_pm10']}_n").alias("count"))
    )
