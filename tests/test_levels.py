"""Categories beyond the known ones, NaN as missing, and CSV folders with differing headers."""

import pytest

from stationflow.operators.features import drop_accounting, drop_nulls
from stationflow.operators.matrix import data_categories, one_hot
from stationflow.operators.medians import exact_median_fill, null_counts
from stationflow.operators.summary import null_profile, radar_pivot
from stationflow.plans.prediction import batch_predict
from stationflow.schemas import CITY_LEVELS, SUMMARY_MEASURES, TARGET_NAMES
from stationflow.sources.files import read_csv


def test_other_cities_get_columns(spark):
    frame = spark.createDataFrame([("athens", "fall"), ("porto", "monsoon"), (None, "fall")], "city string, season string")
    encoded = one_hot(frame)
    assert encoded.columns[: len(CITY_LEVELS) + 1] == [*(f"city_{c}" for c in CITY_LEVELS), "city_porto"]
    assert sorted(r.city_porto for r in encoded.collect()) == [0, 0, 1]
    assert data_categories(frame)["season"][-1] == "monsoon"
    with pytest.raises(ValueError):
        data_categories(frame, max_levels=1)


def test_other_cities_stay_in_the_pivot(spark):
    measures = list(SUMMARY_MEASURES)
    rows = [("athens", *(1.0 for _ in measures), 1), ("porto", *(2.0 for _ in measures), 1)]
    summary = spark.createDataFrame(rows, f"city string, {', '.join(f'{m} double' for m in measures)}, count long")
    assert {r["Porto"] for r in radar_pivot(summary).collect()} == {2.0}


def test_nan_is_missing_everywhere(spark):
    frame = spark.createDataFrame([(1.0, 1), (float("nan"), 2), (None, 3), (4.0, None)], "x double, n int")
    account = drop_accounting(frame, ["x"]).first()
    assert (account.rows_before, account.rows_after) == (4, drop_nulls(frame, ["x"]).count()) == (4, 2)
    assert null_counts(frame).first().asDict() == {"x": 2, "n": 1}
    assert sorted(r.x for r in exact_median_fill(frame).collect()) == [1.0, 2.5, 2.5, 4.0]
    profile = {r["column"]: r.nulls for r in null_profile(frame.withColumnRenamed("n", "m").selectExpr("x", "1 as k"), only_incomplete=True).collect()}
    assert profile == {"x": 2}


def test_differing_headers_are_an_error(spark, tmp_path):
    (tmp_path / "a.csv").write_text("pm10,no2\n1,2\n")
    (tmp_path / "b.csv").write_text("no2,pm10\n3,4\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_csv(spark, str(tmp_path)).collect()


def test_predictions_without_models_keep_their_columns(spark):
    snapshots = spark.createDataFrame([("S1", 1.0)], "station_name string, pm10 double")
    got = batch_predict(snapshots, {}, keep=("station_name",))
    assert [f"{n}_prediction" for n in TARGET_NAMES.values()] == [c for c in got.columns if c.endswith("_prediction")]
    assert got.count() == 1
