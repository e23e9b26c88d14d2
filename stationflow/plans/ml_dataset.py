"""The canonical table to the table models learn from."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from ..operators.blocks import ROWS_PER_BLOCK
from ..operators.clean import project_existing
from ..operators.features import (
    drop_nulls,
    pollutant_ratios,
    temporal_features,
    weather_features,
    window_features,
)
from ..schemas import ML_COLUMNS, ML_SCHEMA
from ..sources import ML_TABLE, create_tables, read_dataset, replace_cities, write_csv, write_jdbc, write_parquet


def ml_features(
    raw: DataFrame, order: Sequence[str] = ("date",), rows_per_block: int | None = ROWS_PER_BLOCK
) -> DataFrame:
    """All features and targets, rows with nulls included.

    The row-wise features come after the windows, so only the source columns move.
    """
    return (
        window_features(raw, order, rows_per_block)
        .transform(temporal_features)
        .transform(weather_features)
        .transform(pollutant_ratios)
        .transform(project_existing, ML_COLUMNS)
    )


def build_ml_dataset(
    raw: DataFrame, order: Sequence[str] = ("date",), rows_per_block: int | None = ROWS_PER_BLOCK
) -> DataFrame:
    """The complete rows of :func:`ml_features`, in the 51-column layout."""
    return drop_nulls(ml_features(raw, order, rows_per_block))


def write_ml_dataset(
    df: DataFrame,
    output_dir: str,
    csv: bool = True,
    csv_files: int | None = None,
    jdbc: dict[str, str] | None = None,
    table: str = ML_TABLE,
    catalog: bool = False,
) -> DataFrame:
    """Write Parquet, and CSV, a database table and a catalog table on demand; returns the written dataset.

    The features are computed once: the other sinks read the Parquet. In the catalog table the cities of ``df`` replace
    their rows, and other cities stay.
    """
    path = f"{output_dir}/ml_air_quality.parquet"
    write_parquet(df, path)
    written = read_dataset(df.sparkSession, path)
    if csv:
        write_csv(written, f"{output_dir}/ml_air_quality.csv", files=csv_files)
    if jdbc:
        write_jdbc(written, table, jdbc)
    if catalog:
        create_tables(df.sparkSession, {table: ML_SCHEMA})
        replace_cities(written, table)
    return written
