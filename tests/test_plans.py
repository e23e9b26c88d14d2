"""Whole pipelines on the small test tables."""

from dataclasses import replace

import pytest

from stationflow.checks import views
from stationflow.operators import features
from stationflow.operators.matrix import scaler_fit
from stationflow.plans import batch_predict, build_ml_dataset, load_and_unify, load_model, save_model, train_all, write_ml_dataset
from stationflow.plans import pipeline
from stationflow.plans.training import training_frame
from stationflow.schemas import ML_COLUMNS, RAW_COLUMNS, TARGETS, default_sources
from stationflow.sources import ML_TABLE, RAW_TABLE, read_dataset, write_csv

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def data_dir(spark, tmp_path_factory):
    """The three city files."""
    folder = tmp_path_factory.mktemp("cities")
    for spec, frame in views.city_sources(spark, SF_DIR):
        write_csv(frame, f"{folder}/{spec.city}_data.csv")
    return str(folder)


@pytest.fixture(scope="module")
def dataset(spark, data_dir, tmp_path_factory):
    raw = load_and_unify(spark, default_sources(data_dir))
    return write_ml_dataset(build_ml_dataset(raw), str(tmp_path_factory.mktemp("out")))


def test_staging_does_not_change_the_result(spark, data_dir, rows):
    specs = default_sources(data_dir)
    direct = load_and_unify(spark, specs, stage=False)
    assert direct.columns == RAW_COLUMNS
    assert rows(direct) == rows(load_and_unify(spark, specs))


def test_dataset_files_agree(spark, dataset, tmp_path, rows):
    write_ml_dataset(dataset, str(tmp_path), csv_files=1)
    parquet = read_dataset(spark, f"{tmp_path}/ml_air_quality.parquet")
    csv = read_dataset(spark, f"{tmp_path}/ml_air_quality.csv")
    assert parquet.columns == csv.columns == ML_COLUMNS and parquet.dtypes == csv.dtypes
    assert rows(parquet) == rows(csv)


def test_steps_fill_the_catalog_tables(spark, data_dir, tmp_path, rows):
    path = pipeline.run_etl(spark, data_dir, str(tmp_path), catalog=True)
    written = pipeline.run_features(spark, str(tmp_path), catalog=True)
    raw = read_dataset(spark, path)
    assert rows(spark.table(RAW_TABLE).select(*raw.columns)) == rows(raw)
    assert rows(spark.table(ML_TABLE).select(*ML_COLUMNS)) == rows(written)
    some = written.filter("city = 'ancona'").limit(3)
    write_ml_dataset(some, str(tmp_path / "again"), csv=False, catalog=True)
    counts = {r["city"]: r["count"] for r in spark.table(ML_TABLE).groupBy("city").count().collect()}
    expected = {r["city"]: r["count"] for r in written.groupBy("city").count().collect()}
    assert counts == expected | {"ancona": 3}


def test_training_frame(dataset):
    frame, columns = training_frame(dataset)
    assert len(columns) == 51 and not {*TARGETS, "split", "date", "station_name"} & set(columns)
    assert frame.count() == dataset.count()


def test_no_training_without_rows(dataset):
    assert train_all(dataset.limit(0)) is None


def test_models_survive_saving(spark, dataset, tmp_path):
    models, metrics = train_all(dataset, iterations=2, depth=2)
    save_model(models, metrics, str(tmp_path))
    loaded = load_model(spark, str(tmp_path))
    assert set(loaded) == set(TARGETS)
    lines = [r[0] for r in spark.read.text(f"{tmp_path}/metrics.txt").collect()]
    assert [line.split(":")[0] for line in lines] == ["o3", "pm10", "pm25"]
    assert all(r["rmse"] > 0 for r in spark.read.parquet(f"{tmp_path}/metrics.parquet").collect())

    snapshots = features.temporal_features(views.readings(spark, SF_DIR)).limit(50).cache()
    key = ("station_name", "date")
    before = sorted(map(tuple, batch_predict(snapshots, models, key).collect()))
    assert before == sorted(map(tuple, batch_predict(snapshots, loaded, key).collect()))
    assert len(before) == 50

    # A target scaler undoes the scaling of a model's output.
    stats = scaler_fit(dataset, TARGETS)
    scaled = batch_predict(snapshots, models, key, target_scaler=stats).collect()
    s = stats.first()
    plain = {r[:2]: r for r in before}
    for r in scaled:
        expected = plain[(r["station_name"], r["date"])][2] * s["pm10_next_24h_mean_std"] + s["pm10_next_24h_mean_mean"]
        assert r["pm10_prediction"] == pytest.approx(expected)


def test_steps(spark, data_dir, tmp_path, monkeypatch):
    monkeypatch.setattr(pipeline, "get_session", lambda: spark)
    trained = []
    monkeypatch.setattr(pipeline, "save_model", lambda *a: trained.append(a))
    monkeypatch.setattr(pipeline, "train_all", lambda d: ("models", d.count()))
    common = ["--data-dir", data_dir, "--output-dir", str(tmp_path)]
    pipeline.main(["--steps", "etl", *common])
    assert (tmp_path / "raw_air_quality.parquet").exists() and not (tmp_path / "ml_air_quality.parquet").exists()
    pipeline.main(["--steps", "features", "train", *common])
    assert trained[0][1] == read_dataset(spark, f"{tmp_path}/ml_air_quality.parquet").count() > 0
    with pytest.raises(SystemExit):
        pipeline.main(["--steps", "serve", *common])


def test_missing_input_of_a_step(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        pipeline.run_features(spark, str(tmp_path))


def test_sources_are_described_once():
    specs = default_sources("d")
    assert [(s.city, s.temp_unit, s.has_pm25) for s in specs] == [
        ("athens", "celsius", True), ("ancona", "fahrenheit", True), ("zaragoza", "celsius", False),
    ]
    assert replace(specs[0], path="x").path == "x"
