"""One query per operator; each reads the test tables below ``sf_dir`` and returns a DataFrame.

Doubles are rounded to six digits, as sums of doubles differ between engines in their last bits.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import aqi_alert, aqi_description, aqi_label, aqi_level_by_key
from ..operators import clean, features, matrix, medians, metrics, sequences, summary
from ..operators.scalars import evaluated
from ..operators.snapshot import snapshot_features
from ..plans import (
    batch_predict,
    build_ml_dataset,
    load_sources,
    sequence_study,
    stored_summary,
    train_all,
    update_summary,
    write_study,
)
from ..plans.ml_dataset import ml_features
from ..plans.sequence_study import cell_digest
from ..schemas import IMPUTED, POLLUTANTS, ROLLING, TARGETS
from ..sources import create_tables, read_dataset, replace_cities, shared_dir, staged, write_csv, write_parquet
from . import views

Query = Callable[[SparkSession, str], DataFrame]

KEYS = ["station_name", "date"]
SEQUENCE_TARGET = "o3_next_24h_max"
NAIVE = {
    "pm10": ("pm10_next_24h_mean", "pm10_roll_24h_mean"),
    "pm25": ("pm25_next_24h_mean", "pm25_roll_24h_mean"),
    "o3": ("o3_next_24h_max", "o3_roll_24h_max"),
}
NAIVE_MODELS = {"rolling_max": "o3_roll_24h_max", "rolling_mean": "o3_roll_24h_mean", "last_value": "o3"}

_QUERIES: dict[str, Query] = {}


def _query(function: Query) -> Query:
    _QUERIES[function.__name__] = function
    return function


def rounded(df: DataFrame, digits: int = 6, only: Sequence[str] = ()) -> DataFrame:
    """Round the floating-point columns, or those of ``only``."""
    reals = [c for c, t in df.dtypes if t in ("double", "float") and (not only or c in only)]
    return df.withColumns({c: F.round(F.col(c).cast("double"), digits) for c in reals})


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.clean(staged(clean.unify_sources(views.city_sources(spark, sf_dir)), "unified"))


def with_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned rows that have the sequence target."""
    targets = features.target_features(staged(cleaned(spark, sf_dir), "cleaned"))
    return staged(targets.dropna(subset=[SEQUENCE_TARGET]), "with_targets")


def ml_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_ml_dataset(staged(cleaned(spark, sf_dir), "cleaned"))


def summary_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.city_summary(cleaned(spark, sf_dir))


# --- Sources and sinks ---


@_query
def csv_roundtrip(spark, sf_dir):
    specs = []
    for spec, frame in views.city_sources(spark, sf_dir):
        path = shared_dir(spark, f"{spec.city}.csv")
        write_csv(frame, path)
        specs.append(replace(spec, path=path))
    return rounded(clean.parse_timestamp(load_sources(spark, specs)))


@_query
def parquet_roundtrip(spark, sf_dir):
    path = f"{shared_dir(spark, 'readings')}.parquet"
    write_parquet(views.readings(spark, sf_dir), path, partition_by=["city"])
    return read_dataset(spark, path)


@_query
def catalog_rerun(spark, sf_dir):
    """All cities into a catalog table, then one of them again with other values."""
    table, path = views.readings(spark, sf_dir), shared_dir(spark, "catalog")
    name = "readings_" + "".join(c for c in path.rsplit("/", 1)[-1] if c.isalnum())
    create_tables(spark, {name: table.schema}, {name: path})
    replace_cities(table, name)
    replace_cities(table.filter("city = 'ancona'").withColumn("pm10", F.col("pm10") + 1), name)
    return spark.table(name)


@_query
def read_dataset_csv(spark, sf_dir):
    path = f"{shared_dir(spark, 'readings')}.csv"
    write_csv(views.readings(spark, sf_dir), path)
    return read_dataset(spark, f"{path}.absent.parquet", path)


# --- Cleaning ---


@_query
def rename_columns(spark, sf_dir):
    renamed = [
        clean.rename_columns(frame).withColumn("city", F.lit(spec.city)) for spec, frame in views.city_sources(spark, sf_dir)
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), renamed)


@_query
def unify_sources(spark, sf_dir):
    return rounded(clean.parse_timestamp(clean.unify_sources(views.city_sources(spark, sf_dir))))


@_query
def project_canonical(spark, sf_dir):
    return clean.project_existing(features.temporal_features(views.readings(spark, sf_dir)))


@_query
def fahrenheit_to_celsius(spark, sf_dir):
    converted = clean.fahrenheit_to_celsius(views.readings(spark, sf_dir))
    return rounded(converted.select(*KEYS, "city", "dewpoint_temp", "soil_temp", "temp"))


@_query
def parse_timestamp(spark, sf_dir):
    readings = views.readings(spark, sf_dir)
    text = F.when(F.col("relative_humidity") % 11 == 0, "not a date").otherwise(
        F.date_format("date", "yyyy-MM-dd HH:mm:ss")
    )
    return clean.parse_timestamp(readings.select("station_name", text.alias("text"), text.alias("date")))


@_query
def pm25_ratio(spark, sf_dir):
    return rounded(clean.pm25_ratio(views.readings(spark, sf_dir)))


@_query
def impute_pm25(spark, sf_dir):
    return rounded(clean.impute_pm25(views.readings(spark, sf_dir)).select(*KEYS, "city", "pm10", "pm2_5"))


@_query
def drop_all_null(spark, sf_dir):
    return clean.drop_all_null(views.readings(spark, sf_dir))


@_query
def column_medians(spark, sf_dir):
    return medians.column_medians(views.readings(spark, sf_dir), IMPUTED)


@_query
def column_medians_dense(spark, sf_dir):
    return medians.column_medians(views.readings_dense(spark, sf_dir), [*POLLUTANTS, "l_extendedprice"])


@_query
def median_impute(spark, sf_dir):
    return medians.median_impute(views.readings(spark, sf_dir), IMPUTED)


@_query
def exact_median_fill(spark, sf_dir):
    return medians.exact_median_fill(views.readings(spark, sf_dir))


@_query
def load_and_unify(spark, sf_dir):
    return rounded(cleaned(spark, sf_dir))


# --- Features ---


@_query
def temporal_features(spark, sf_dir):
    return features.temporal_features(views.readings(spark, sf_dir).select(*KEYS))


@_query
def weather_features(spark, sf_dir):
    return rounded(
        features.weather_features(views.readings(spark, sf_dir)).select(
            *KEYS, "wind_speed", "wind_direction", "temp_dewpoint_spread", "temp_soil_diff"
        )
    )


@_query
def pollutant_ratios(spark, sf_dir):
    return rounded(
        features.pollutant_ratios(views.readings(spark, sf_dir)).select(*KEYS, "pm10_pm25_ratio", "no2_o3_balance")
    )


@_query
def rolling_24(spark, sf_dir):
    return rounded(features.rolling_features(views.readings(spark, sf_dir).select(*KEYS, *POLLUTANTS)))


@_query
def lag_features(spark, sf_dir):
    return features.lag_features(views.readings(spark, sf_dir).select(*KEYS, *POLLUTANTS))


@_query
def targets_24(spark, sf_dir):
    return rounded(features.target_features(views.readings(spark, sf_dir).select(*KEYS, *POLLUTANTS)))


@_query
def window_features_dense(spark, sf_dir):
    table = features.window_features(views.readings_dense(spark, sf_dir), views.DENSE_ORDER)
    return rounded(table, only=[*ROLLING, *TARGETS])


@_query
def drop_nulls(spark, sf_dir):
    return features.drop_nulls(views.readings(spark, sf_dir))


@_query
def drop_accounting(spark, sf_dir):
    return rounded(features.drop_accounting(views.readings(spark, sf_dir)))


@_query
def build_ml_dataset_query(spark, sf_dir):
    return rounded(ml_dataset(spark, sf_dir))


# --- Summaries ---


@_query
def city_summary(spark, sf_dir):
    """Of a stored dataset, from the states of its parts."""
    path = shared_dir(spark, "dataset")
    write_parquet(cleaned(spark, sf_dir), f"{path}.parquet")
    return stored_summary(spark, f"{path}.parquet", f"{path}-states")


@_query
def city_summary_added(spark, sf_dir):
    """The same with the dataset in two deliveries and an update after each."""
    path = shared_dir(spark, "dataset")
    table = staged(cleaned(spark, sf_dir), "cleaned")
    late = F.month("date") % 2 == 0
    for delivered in (table.filter(~late), table.filter(late)):
        write_parquet(delivered, f"{path}.parquet", mode="append")
        update_summary(spark, f"{path}.parquet", f"{path}-states")
    return stored_summary(spark, f"{path}.parquet", f"{path}-states")


@_query
def capitalize_city(spark, sf_dir):
    return summary.capitalize_city(summary_of(spark, sf_dir))


@_query
def select_measures(spark, sf_dir):
    return summary.select_measures(summary_of(spark, sf_dir), ["avg_o3", "avg_pm10"])


@_query
def cross_city_stats(spark, sf_dir):
    return rounded(summary.cross_city_stats(summary_of(spark, sf_dir)))


@_query
def cross_city_share(spark, sf_dir):
    return rounded(summary.cross_city_share(summary_of(spark, sf_dir)))


@_query
def summary_aqi(spark, sf_dir):
    return rounded(summary.summary_aqi(summary_of(spark, sf_dir)))


@_query
def radar_pivot(spark, sf_dir):
    return summary.radar_pivot(summary_of(spark, sf_dir))


@_query
def aqi_classify(spark, sf_dir):
    values = views.readings(spark, sf_dir).unpivot(KEYS, [*POLLUTANTS, "temp"], "measure", "value")
    level = F.col("level")
    return values.withColumn("level", aqi_level_by_key(F.col("measure"), F.col("value"))).withColumns(
        {"label": aqi_label(level), "description": aqi_description(level), "alert": aqi_alert(level)}
    )


@_query
def null_profile(spark, sf_dir):
    return summary.null_profile(ml_features(views.readings(spark, sf_dir)))


@_query
def dataset_profile(spark, sf_dir):
    return summary.dataset_profile(views.readings(spark, sf_dir))


@_query
def preview(spark, sf_dir):
    return rounded(summary.preview(cleaned(spark, sf_dir), 10))


# --- Model inputs ---


@_query
def drop_null_targets(spark, sf_dir):
    readings = views.readings(spark, sf_dir).select(*KEYS, *POLLUTANTS)
    return rounded(matrix.drop_null_targets(features.target_features(readings)).select(*KEYS, *TARGETS))


@_query
def one_hot(spark, sf_dir):
    return matrix.one_hot(
        features.temporal_features(views.readings(spark, sf_dir)).select(*KEYS, "city", "season")
    )


@_query
def model_matrix(spark, sf_dir):
    table = staged(ml_features(views.readings(spark, sf_dir)), "ml_features", wide=True)
    return rounded(matrix.prepare_features(table, keep=KEYS)[0], 4)


def _with_special_values(readings: DataFrame) -> DataFrame:
    x = (
        F.when(F.col("temp") == 0, float("nan"))
        .when(F.col("temp") == 1, float("inf"))
        .when(F.col("temp") == 2, float("-inf"))
        .otherwise(F.col("pm10"))
    )
    return readings.select(*KEYS, "temp", x.alias("x"))


@_query
def finite_only(spark, sf_dir):
    return matrix.finite_only(_with_special_values(views.readings(spark, sf_dir)), ["x"])


@_query
def drop_accounting_special(spark, sf_dir):
    return rounded(features.drop_accounting(_with_special_values(views.readings(spark, sf_dir))))


@_query
def null_counts_special(spark, sf_dir):
    return medians.null_counts(_with_special_values(views.readings(spark, sf_dir)))


@_query
def exact_median_fill_special(spark, sf_dir):
    return medians.exact_median_fill(_with_special_values(views.readings(spark, sf_dir)), ["x", "temp"])


def _far_city(readings: DataFrame) -> DataFrame:
    """Readings of which some belong to a city that no schema names."""
    city = F.when(F.col("station_name").isin("S1", "S4", "S7"), "porto").otherwise(F.col("city"))
    return readings.withColumn("city", city)


@_query
def radar_pivot_other_city(spark, sf_dir):
    return summary.radar_pivot(summary.city_summary(_far_city(cleaned(spark, sf_dir))))


@_query
def one_hot_other_city(spark, sf_dir):
    readings = features.temporal_features(_far_city(views.readings(spark, sf_dir)))
    return matrix.one_hot(readings.select(*KEYS, "city", "season"))


@_query
def column_medians_bracketed(spark, sf_dir):
    dense = views.readings_dense(spark, sf_dir)
    return medians.column_medians(dense, [*POLLUTANTS, "l_extendedprice"], sample_rows=5_000)


@_query
def window_features_cut(spark, sf_dir):
    dense = staged(views.readings_dense(spark, sf_dir), "dense")
    return rounded(features.window_features(dense, views.DENSE_ORDER, rows_per_block=150), only=[*ROLLING, *TARGETS])


@_query
def finite_check(spark, sf_dir):
    return matrix.finite_check(_with_special_values(views.readings(spark, sf_dir)), ["temp", "x"])


def _prepared(spark, sf_dir):
    """All model inputs and targets, and their names."""
    table = staged(ml_features(views.readings(spark, sf_dir)), "ml_features", wide=True)
    frame, columns = matrix.prepare_features(table, keep=KEYS)
    return staged(frame, "prepared", wide=True), [*columns, *TARGETS]


@_query
def scaler_fit(spark, sf_dir):
    return rounded(matrix.scaler_fit(*_prepared(spark, sf_dir)))


@_query
def standard_scale(spark, sf_dir):
    table, columns = _prepared(spark, sf_dir)
    return rounded(matrix.standard_scale(table, matrix.scaler_fit(table, columns), columns), 4)


@_query
def inverse_scale(spark, sf_dir):
    table, columns = _prepared(spark, sf_dir)
    stats = evaluated(matrix.scaler_fit(table, columns))
    return rounded(matrix.inverse_scale(matrix.standard_scale(table, stats, columns), stats, columns), 4)


@_query
def hash_split(spark, sf_dir):
    return matrix.hash_split(views.readings(spark, sf_dir).select(*KEYS))


@_query
def snapshot(spark, sf_dir):
    return rounded(snapshot_features(features.temporal_features(views.readings(spark, sf_dir)), tuple(KEYS)))


# --- Sequences ---


@_query
def sequence_starts(spark, sf_dir):
    return sequences.sequence_starts(with_targets(spark, sf_dir)).select(*KEYS, "row_number", "station_rows")


def _study(spark, sf_dir):
    return sequence_study(staged(ml_features(staged(cleaned(spark, sf_dir), "cleaned")), "ml_features", wide=True), SEQUENCE_TARGET)


@_query
def sequences_24(spark, sf_dir):
    """Every sequence of all scaled features, from the stored chunks; its cells as a digest of all of them."""
    study = write_study(_study(spark, sf_dir), shared_dir(spark, "study"))
    return rounded(
        study.sequences().select(
            *KEYS,
            "position",
            "split",
            F.size("sequence").alias("cells"),
            cell_digest().alias("digest"),
            F.col("target").cast("double").alias("target"),
        ),
        3,
    )


@_query
def ordered_split(spark, sf_dir):
    return sequences.ordered_split(with_targets(spark, sf_dir)).select(
        *KEYS, "row_number", "station_rows", "position", "split"
    )


@_query
def train_rows(spark, sf_dir):
    return sequences.train_rows(with_targets(spark, sf_dir)).select(*KEYS)


@_query
def scaler_fit_train(spark, sf_dir):
    return rounded(_study(spark, sf_dir).stats)


# --- Models ---


@_query
def regression_metrics(spark, sf_dir):
    return rounded(metrics.regression_metrics(ml_dataset(spark, sf_dir), NAIVE))


@_query
def model_comparison(spark, sf_dir):
    return rounded(metrics.model_comparison(ml_dataset(spark, sf_dir), SEQUENCE_TARGET, NAIVE_MODELS))


def _trained(spark, sf_dir):
    return train_all(staged(ml_dataset(spark, sf_dir), "ml_dataset", wide=True))


@_query
def gbt_metrics(spark, sf_dir):
    trained = _trained(spark, sf_dir)
    return spark.createDataFrame([], "target string, n bigint, rmse double, r2 double") if trained is None else trained[1]


@_query
def batch_prediction(spark, sf_dir):
    snapshots = features.temporal_features(views.readings(spark, sf_dir))
    models, _ = _trained(spark, sf_dir) or ({}, None)
    return batch_predict(snapshots, models, keep=tuple(KEYS))


_RENAMED = {
    "read_dataset_csv": "read_dataset",
    "build_ml_dataset_query": "build_ml_dataset",
    "snapshot": "snapshot_features",
    "sequences_24": "sequences",
    "batch_prediction": "batch_predict",
}


def all_queries() -> dict[str, Query]:
    return {_RENAMED.get(name, name): function for name, function in _QUERIES.items()}
