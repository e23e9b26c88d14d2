"""CSV and Parquet."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..schemas import COLUMN_MAP, ML_COLUMNS, RAW_COLUMNS, SourceSpec, type_of

_KNOWN = {*RAW_COLUMNS, *ML_COLUMNS}


def read_csv(
    spark: SparkSession, path: str, text: Sequence[str] = (), infer: bool = False, files: str = "*"
) -> DataFrame:
    """CSV with a header. Known columns get their types by name, others and those in ``text`` stay strings.

    Only the header is looked at before the query runs; ``infer`` makes Spark read everything once more instead.
    Values that do not fit their type become null. In a directory only file names that match ``files`` are read; a file
    whose header has other columns, or another order, is an error when the query runs.
    """
    reader = spark.read.option("header", True).option("pathGlobFilter", files)
    if infer:
        return reader.option("inferSchema", True).csv(path)

    def field(header: str) -> StructField:
        column = COLUMN_MAP.get(header, header)
        typed = column in _KNOWN and column not in text
        return StructField(header, type_of(column) if typed else StringType())

    schema = StructType([field(h) for h in reader.csv(path).columns])
    return reader.option("enforceSchema", False).schema(schema).csv(path)


def read_source(spark: SparkSession, spec: SourceSpec, infer: bool = False) -> DataFrame:
    """One city source as it is; dates stay text until they are parsed leniently while cleaning."""
    return read_csv(spark, spec.path, text=["date"], infer=infer)


_ABSENT = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def _try_read(spark: SparkSession, path: str, form: str, files: str) -> DataFrame | None:
    try:
        if form == "parquet":
            return spark.read.option("pathGlobFilter", files).parquet(path)
        frame = read_csv(spark, path, files=files)
        return frame if frame.columns else None
    except AnalysisException as error:
        if error.getCondition() in _ABSENT:
            return None
        raise


def read_dataset(spark: SparkSession, *paths: str) -> DataFrame:
    """The first of ``paths`` that holds data: a file, or a directory of part files.

    The names of the part files tell Parquet from CSV; without such names the suffix of the path does, and CSV is the
    default. An error names the paths when none holds data.
    """
    for path in paths:
        named = "parquet" if path.rstrip("/").endswith(".parquet") else "csv"
        for form, files in (("parquet", "*.parquet"), ("csv", "*.csv*"), (named, "*")):
            found = _try_read(spark, path, form, files)
            if found is not None:
                return found
    raise FileNotFoundError(f"no dataset at {', '.join(paths)}; run the etl and features steps first")


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = ()) -> None:
    writer = df.write.mode(mode)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", files: int | None = None) -> None:
    """CSV with a header. ``files`` caps the number of files; 1 suits small results only, as one task writes it all."""
    (df if files is None else df.coalesce(files)).write.mode(mode).option("header", True).csv(path)


def write_metrics(metrics: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One line per target: its name and RMSE with four digits."""
    metrics.orderBy("target").select(F.format_string("%s: RMSE=%.4f", "target", "rmse").alias("value")).coalesce(
        1
    ).write.mode(mode).text(path)
