"""From differently shaped sources to one clean canonical table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import celsius
from ..schemas import (
    COLUMN_MAP,
    DEFAULT_RATIO,
    IMPUTED,
    POLLUTANTS,
    RATIO_CITIES,
    RAW_COLUMNS,
    TEMPERATURES,
    SourceSpec,
    type_of,
)
from .medians import median_impute
from .scalars import evaluated, with_scalars


def rename_columns(df: DataFrame, mapping: dict[str, str] = COLUMN_MAP) -> DataFrame:
    """Source headers to canonical names; names that are absent are ignored."""
    return df.withColumnsRenamed(mapping)


def add_missing_columns(df: DataFrame, spec: SourceSpec) -> DataFrame:
    """Typed nulls for what the source lacks, and its city."""
    absent = ([] if spec.has_pm25 else ["pm2_5"]) + ([] if spec.has_code_id else ["code", "id"])
    return df.withColumns(
        {**{c: F.lit(None).cast(type_of(c)) for c in absent}, "city": F.lit(spec.city)}
    )


def project_existing(df: DataFrame, order: Sequence[str] = RAW_COLUMNS) -> DataFrame:
    """The columns of ``order`` that exist, in that order."""
    return df.select(*[c for c in order if c in df.columns])


def fahrenheit_to_celsius(df: DataFrame, cities: Sequence[str] = ("ancona",)) -> DataFrame:
    """Convert the temperatures of the cities that report Fahrenheit."""
    if not cities:
        return df
    converted = F.col("city").isin(list(cities))
    return df.withColumns(
        {c: F.when(converted, celsius(F.col(c))).otherwise(F.col(c)) for c in TEMPERATURES if c in df.columns}
    )


def unify_sources(sources: Sequence[tuple[SourceSpec, DataFrame]]) -> DataFrame:
    """Rename, complete and stack the sources by column name, in canonical order, temperatures in Celsius."""
    shaped = [rename_columns(df).transform(add_missing_columns, spec) for spec, df in sources]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), shaped)
    fahrenheit = [spec.city for spec, _ in sources if spec.temp_unit == "fahrenheit"]
    return fahrenheit_to_celsius(project_existing(stacked), fahrenheit)


def pm25_ratio(df: DataFrame, cities: Sequence[str] = RATIO_CITIES, default: float = DEFAULT_RATIO) -> DataFrame:
    """One row: the mean PM2.5 : PM10 ratio of the rows that have both."""
    usable = (
        F.col("city").isin(list(cities)) & F.col("pm2_5").isNotNull() & (F.col("pm10") > 0)
    )
    return df.filter(usable).agg(F.coalesce(F.avg(F.col("pm2_5") / F.col("pm10")), F.lit(default)).alias("ratio"))


def impute_pm25(df: DataFrame, ratio: DataFrame | None = None) -> DataFrame:
    """Estimate missing PM2.5 from PM10 by the mean ratio."""
    estimate = F.col("pm10") * F.col("_stats.ratio")
    return (
        with_scalars(df, pm25_ratio(df) if ratio is None else ratio)
        .withColumn("pm2_5", F.coalesce(F.col("pm2_5"), estimate))
        .drop("_stats")
    )


def parse_timestamp(df: DataFrame, column: str = "date") -> DataFrame:
    """Text to timestamp; unreadable text becomes null."""
    if dict(df.dtypes)[column] == "timestamp":
        return df
    if dict(df.dtypes)[column] != "string":
        return df.withColumn(column, F.col(column).cast("timestamp"))
    return df.withColumn(column, F.try_to_timestamp(column))


def drop_all_null(df: DataFrame, columns: Sequence[str] = POLLUTANTS) -> DataFrame:
    """Keep rows with at least one of the columns."""
    return df.filter(F.coalesce(*[F.col(c) for c in columns]).isNotNull())


def clean(df: DataFrame, accuracy: int | None = None) -> DataFrame:
    """Impute PM2.5, parse dates, drop rows without any pollutant, fill the rest with medians.

    The ratio and the medians are computed at once, as each pass over the data would need them again.
    """
    return (
        impute_pm25(df, evaluated(pm25_ratio(df)))
        .transform(parse_timestamp)
        .transform(drop_all_null)
        .transform(median_impute, IMPUTED, accuracy)
    )
