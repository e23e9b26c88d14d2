"""City summaries, cross-city statistics and dataset profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import aqi_alert, aqi_description, aqi_label, aqi_level_by_key, capitalize_first, half_up
from ..schemas import CITY_LEVELS, SUMMARY_MEASURES
from .matrix import category_levels, with_known
from .medians import null_counts
from .scalars import with_scalars

MEASURES = tuple(SUMMARY_MEASURES)
#: Summary means and the columns they are of.
CITY_MEANS = {"avg_pm10": "pm10", "avg_pm25": "pm2_5", "avg_no2": "no2", "avg_o3": "o3"}
ALL_CITIES = "all"


def city_summary(df: DataFrame) -> DataFrame:
    """Per city: pollutant means rounded to 2 digits and the number of PM10 values."""
    return df.groupBy("city").agg(
        *[half_up(F.avg(c), 2).alias(name) for name, c in CITY_MEANS.items()], F.count("pm10").alias("count")
    ).filter(F.col("city").isNotNull())


def capitalize_city(summary: DataFrame) -> DataFrame:
    return summary.withColumn("city", capitalize_first(F.col("city")))


def measures_long(summary: DataFrame, measures: Sequence[str] = MEASURES) -> DataFrame:
    """(city, measure, value) for the chosen measures."""
    return summary.unpivot(["city"], list(measures), "measure", "value")


def select_measures(summary: DataFrame, measures: Sequence[str]) -> DataFrame:
    """The chosen measures, in their usual order whatever the order of choosing."""
    return measures_long(summary, [m for m in MEASURES if m in measures])


def cross_city_stats(summary: DataFrame) -> DataFrame:
    """Per measure: the unweighted mean of the cities and their maximum, which is at least 1."""
    return (
        measures_long(summary)
        .groupBy("measure")
        .agg(F.avg("value").alias("mean"), F.greatest(F.max("value"), F.lit(1.0)).alias("max"))
    )


def _wide_stats(summary: DataFrame, measures: Sequence[str]) -> DataFrame:
    return summary.agg(
        *[F.avg(m).alias(f"{m}_mean") for m in measures],
        *[F.greatest(F.max(m), F.lit(1.0)).alias(f"{m}_max") for m in measures],
    )


def _with_all_cities(summary: DataFrame) -> DataFrame:
    """Summary rows plus one row holding the cross-city means, in long form."""
    overall = summary.agg(*[F.avg(m).alias(m) for m in MEASURES]).select(F.lit(ALL_CITIES).alias("city"), *MEASURES)
    return measures_long(summary.select("city", *MEASURES).unionByName(overall))


def cross_city_share(summary: DataFrame) -> DataFrame:
    """Each city mean, and the cross-city mean, as a percentage of the largest city mean."""
    largest: Column = F
    for m in MEASURES:
        largest = largest.when(F.col("measure") == m, F.col(f"_stats.{m}_max"))
    return (
        with_scalars(_with_all_cities(summary), _wide_stats(summary, MEASURES))
        .withColumn("share", F.col("value") / largest * 100)
        .drop("_stats")
    )


def summary_aqi(summary: DataFrame) -> DataFrame:
    """Health band, its text and the alert flag of every city mean and of the cross-city means."""
    level = F.col("level")
    return (
        _with_all_cities(summary)
        .withColumn("level", aqi_level_by_key(F.col("measure"), F.col("value")))
        .withColumns(
            {"label": aqi_label(level), "description": aqi_description(level), "alert": aqi_alert(level)}
        )
    )


def radar_pivot(summary: DataFrame, cities: Sequence[str] | None = None) -> DataFrame:
    """One row per pollutant, one column per city (name capitalised), means rounded to 1 digit.

    Default: the known cities and all others of the summary.
    """
    cities = with_known(CITY_LEVELS, category_levels(summary, "city")) if cities is None else cities
    names = [c[:1].upper() + c[1:] for c in cities]
    label: Column = F
    for measure, text in SUMMARY_MEASURES.items():
        label = label.when(F.col("measure") == measure, text)
    return (
        measures_long(capitalize_city(summary))
        .groupBy(label.alias("pollutant"))
        .pivot("city", names)
        .agg(half_up(F.max("value"), 1))
    )


def null_profile(
    df: DataFrame, columns: Sequence[str] | None = None, top: int | None = 20, only_incomplete: bool = False
) -> DataFrame:
    """(column, nulls), most nulls first; the ``top`` columns only, or all of them for None.

    NaN counts as null. ``only_incomplete`` leaves out columns without nulls.
    """
    names = list(columns or df.columns)
    profile = null_counts(df, names).unpivot([], names, "column", "nulls").orderBy(F.desc("nulls"), "column")
    if only_incomplete:
        profile = profile.filter("nulls > 0")
    return profile if top is None else profile.limit(top)


def dataset_profile(df: DataFrame) -> DataFrame:
    """One row: rows, distinct stations, first and last date, number of columns."""
    return df.agg(
        F.count("*").alias("rows"),
        F.countDistinct("station_name").alias("stations"),
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
        F.lit(len(df.columns)).alias("columns"),
    )


def column_types(df: DataFrame) -> dict[str, str]:
    return dict(df.dtypes)


def preview(df: DataFrame, rows: int = 5) -> DataFrame:
    """The first rows in (station, date) order."""
    return df.orderBy("station_name", "date").limit(rows)
