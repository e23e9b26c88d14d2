"""Saved preparation: levels, medians and scales that travel with the models."""

import subprocess
import sys
import threading
from pathlib import Path

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression

from stationflow.operators.features import temporal_features
from stationflow.plans import Models, batch_predict, load_model, save_model, train_all, training
from stationflow.plans.preparation import CategoryEncoder, MedianFiller, PopulationScaler, Unscaler, fit_inputs
from stationflow.schemas import CITY_LEVELS, SEASON_LEVELS, TARGETS

ROOT = Path(__file__).resolve().parent.parent


@pytest.fixture
def frame(spark):
    return spark.createDataFrame(
        [("athens", "fall", 1.0, 4), ("porto", None, None, 5), (None, "fall", 2.0, 6), ("ancona", "fall", 50.0, None)],
        "city string, season string, a double, n int",
    )


def reloaded(model, path):
    model.write().overwrite().save(path)
    return type(model).load(path)


def test_levels_are_those_of_the_fit(spark, frame, tmp_path):
    model = reloaded(CategoryEncoder().fit(frame), str(tmp_path / "m"))
    later = spark.createDataFrame([("porto", "fall"), ("oslo", None)], "city string, season string")
    got = model.transform(later)
    assert got.columns == [*(f"city_{c}" for c in [*CITY_LEVELS, "porto"]), *(f"season_{s}" for s in SEASON_LEVELS)]
    assert [r.city_porto for r in got.collect()] == [1, 0] and sum(got.collect()[1]) == 0


def test_medians_are_those_of_the_fit(spark, frame, tmp_path):
    model = reloaded(MedianFiller(inputCols=["a", "n"]).fit(frame), str(tmp_path / "m"))
    later = spark.createDataFrame([(None, None), (float("nan"), 9), (7.0, 1)], "a double, n int")
    assert [tuple(r) for r in model.transform(later).collect()] == [(2.0, 5.0), (2.0, 9.0), (7.0, 1.0)]


def test_scales_by_hand(spark, tmp_path):
    rows = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0), (8.0, 5.0)], "y double, flat double")
    model = reloaded(PopulationScaler(inputCols=["y", "flat"]).fit(rows), str(tmp_path / "m"))
    mean, deviation = model.of("y")
    assert mean == 4.0 and deviation == pytest.approx((26 / 3) ** 0.5) and model.of("flat") == (5.0, 1.0)
    later = spark.createDataFrame([(4.0 + 2 * deviation, 7.0)], "y double, flat double")
    assert tuple(model.transform(later).first()) == pytest.approx((2.0, 2.0))
    back = reloaded(model.unscaler("y", "p"), str(tmp_path / "u"))
    assert isinstance(back, Unscaler)
    assert back.transform(spark.createDataFrame([(2.0,)], "p double")).first().p == pytest.approx(4.0 + 2 * deviation)


def test_predictions_use_the_stored_scales(spark):
    """A line fitted on scaled values gives, by hand, the line through the unscaled ones."""
    rows = spark.createDataFrame([("athens", "spring", float(x), 3.0 * x + 10) for x in range(20)],
                                 "city string, season string, pm10 double, goal double")
    inputs, features = fit_inputs(rows, ["goal"])
    prepared = inputs.transform(rows)
    scaler = PopulationScaler(inputCols=features).fit(prepared)
    targets = PopulationScaler(inputCols=["goal"]).fit(prepared)
    vector = VectorAssembler(inputCols=["pm10"], outputCol="features")
    scaled = vector.transform(targets.transform(scaler.transform(prepared)))
    assert abs(scaled.agg({"goal": "avg"}).first()[0]) < 1e-6
    line = LinearRegression(labelCol="goal", predictionCol="pm10_prediction").fit(scaled)
    model = PipelineModel([line, targets.unscaler("goal", "pm10_prediction")])
    models = Models({TARGETS[0]: model}, PipelineModel([*inputs.stages, scaler, vector]))
    snapshots = spark.createDataFrame([(1, 2.0), (2, None)], "k long, pm10 double")
    got = {r.k: r for r in batch_predict(snapshots, models, ("k",)).collect()}
    assert got[1].pm10_prediction == pytest.approx(16.0, abs=1e-3)
    assert got[2].pm10_prediction == pytest.approx(40.0, abs=1e-3)  # the default reading is 10
    assert got[1].pm25_prediction is None and got[1].pm10_level == "good" and got[1].pm25_level is None


@pytest.fixture(scope="module")
def dataset(spark):
    from stationflow.checks import views
    from stationflow.plans.ml_dataset import ml_features
    from stationflow.sources import staged

    return staged(ml_features(views.readings(spark, "/root/testdata/sf0.01")), "ml_features")


PREDICT = """
import sys
from pyspark.sql import SparkSession
from stationflow.plans import batch_predict, load_model
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config(
    "spark.sql.shuffle.partitions", "2").config("spark.sql.session.timeZone", "UTC").getOrCreate()
folder = sys.argv[1]
snapshots = spark.read.parquet(folder + "/snapshots")
batch_predict(snapshots, load_model(spark, folder), ("station_name", "date")).write.parquet(folder + "/predicted")
"""


def test_equal_predictions_in_a_new_session(spark, dataset, tmp_path, rows):
    models, metrics = train_all(dataset, iterations=2, depth=2)
    save_model(models, metrics, str(tmp_path))
    temporal_features(dataset).select("station_name", "date", "city", "season", "pm10", "temp", "month").limit(40).write.parquet(
        f"{tmp_path}/snapshots"
    )
    subprocess.run([sys.executable, "-c", PREDICT, str(tmp_path)], check=True, cwd=ROOT, timeout=300, capture_output=True)
    here = batch_predict(spark.read.parquet(f"{tmp_path}/snapshots"), load_model(spark, str(tmp_path)), ("station_name", "date"))
    there = rows(spark.read.parquet(f"{tmp_path}/predicted"))
    assert rows(here) == there and len(there) == 40
    whole = models.whole(TARGETS[0])
    assert len(whole.stages) == len(models.preparation.stages) + 2


def test_targets_are_trained_at_the_same_time(dataset, monkeypatch):
    together = threading.Barrier(3, timeout=120)
    plain = training.train_target

    def waits(*arguments):
        together.wait()  # passes only when all three are here
        return plain(*arguments)

    monkeypatch.setattr(training, "train_target", waits)
    models, metrics = train_all(dataset, iterations=1, depth=1)
    assert set(models) == set(TARGETS) and metrics.count() == 3
