"""Summaries kept up with a stored dataset, stored predictions, and counts in the write."""

import logging

import duckdb
import pytest
from pyspark.sql import functions as F

from stationflow.checks import views
from stationflow.operators.features import drop_nulls
from stationflow.operators.summary import city_summary
from stationflow.plans import compare_stored, pipeline, store_predictions, stored_summary, train_all, update_summary, validation_predictions
from stationflow.plans.ml_dataset import build_ml_dataset, ml_features, write_ml_dataset
from stationflow.sources import staged, write_parquet

SF_DIR = "/root/testdata/sf0.01"
TARGET = "o3_next_24h_max"


def readings(spark, rows):
    return spark.createDataFrame(rows, "city string, pm10 double, pm2_5 double, no2 double, o3 double")


def test_absent_dataset_is_an_error(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        stored_summary(spark, str(tmp_path / "none.parquet"), str(tmp_path / "states"))


def test_summary_follows_the_dataset(spark, tmp_path, rows):
    path, states = str(tmp_path / "data.parquet"), str(tmp_path / "states")
    first = readings(spark, [("a", 1.0, None, 2.0, 3.0), ("a", 2.01, 7.0, None, 4.0), (None, 5.0, 1.0, 1.0, 1.0)])
    write_parquet(first, path)
    assert rows(stored_summary(spark, path, states)) == rows(city_summary(first))
    assert update_summary(spark, path, states) == 0  # nothing is read again
    second = readings(spark, [("a", 9.0, 9.0, 9.0, 9.0), ("b", None, None, 1.0, None)]).coalesce(1)
    write_parquet(second, path, mode="append")
    assert update_summary(spark, path, states) == 1
    assert rows(stored_summary(spark, path, states)) == rows(city_summary(first.unionByName(second)))
    write_parquet(second, path)  # the old parts are gone, their states stay
    assert rows(stored_summary(spark, path, states)) == rows(city_summary(second))


def test_nan_counts_for_nothing_in_a_summary(spark, tmp_path):
    path = str(tmp_path / "data.parquet")
    write_parquet(readings(spark, [("a", float("nan"), None, 2.0, 3.0), ("a", 2.0, None, 2.0, 3.0)]), path)
    assert [tuple(r) for r in stored_summary(spark, path, str(tmp_path / "s")).collect()] == [("a", 2.0, None, 2.0, 3.0, 1)]


@pytest.fixture(scope="module")
def dataset(spark):
    return staged(ml_features(views.readings(spark, SF_DIR)), "ml_features")


def test_trained_model_beside_naive_ones(spark, dataset, tmp_path):
    models, metrics = train_all(dataset, [TARGET], iterations=2, depth=2)
    naive = {"rolling_max": "o3_roll_24h_max", "last_value": "o3"}
    path = str(tmp_path / "predictions.parquet")
    stored = store_predictions(validation_predictions(dataset, models, TARGET, naive), path)
    store_predictions(validation_predictions(dataset, models, TARGET, {}), path)  # replaces its own model only
    assert stored.columns == ["date", "station_name", "target", "label", "prediction", "model"]
    got = {r.model: (r.n, r.rmse, r.r2) for r in compare_stored(spark, path).collect()}
    expected = duckdb.sql(f"""
        SELECT model, count(label) FILTER (prediction IS NOT NULL), sqrt(avg(pow(label - prediction, 2))),
               1 - sum(pow(label - prediction, 2)) / sum(pow(label - m, 2))
        FROM (SELECT *, avg(label) FILTER (prediction IS NOT NULL) OVER (PARTITION BY model) AS m
              FROM read_parquet('{path}/*/*.parquet', hive_partitioning = true)) AS p
        WHERE prediction IS NOT NULL GROUP BY model""").fetchall()
    assert set(got) == {"gbt", "rolling_max", "last_value"} == {r[0] for r in expected}
    for model, *values in expected:
        assert got[model] == pytest.approx(tuple(values))
    # The trained model's figures are those of its training, which saw float32 targets.
    trained = metrics.filter("target = 'o3'").first()
    assert got["gbt"][0] == trained.n and got["gbt"][1:] == pytest.approx((trained.rmse, trained.r2), rel=1e-4)


def test_rows_before_and_after_are_counted_in_the_write(spark, tmp_path, caplog):
    raw_path = f"{tmp_path}/raw_air_quality.parquet"
    write_parquet(views.readings(spark, SF_DIR).withColumn("code", F.lit("c")), raw_path)
    raw = spark.read.parquet(raw_path)
    tracker = spark.sparkContext.statusTracker()

    def jobs(name, work):
        spark.sparkContext.setJobGroup(name, name)
        work()
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(tracker.getJobIdsForGroup(name))

    plain = jobs("plain", lambda: write_ml_dataset(build_ml_dataset(spark.read.parquet(raw_path)), str(tmp_path / "plain")))
    with caplog.at_level(logging.INFO, logger="stationflow"):
        counted = jobs("counted", lambda: pipeline.run_features(spark, str(tmp_path)))
    # Finding the part files, and reading the schema, may take a job of its own; counting takes none.
    assert counted <= plain + 1
    before, after = raw.count(), drop_nulls(ml_features(raw)).count()
    assert f"features: {before} rows before dropping nulls, {after} after" in caplog.text
