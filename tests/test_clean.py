from datetime import datetime

import pytest

from stationflow.operators import clean
from stationflow.schemas import RAW_COLUMNS, SourceSpec

SHAPE = "city string, pm10 double, pm2_5 double, no2 double, o3 double"


def test_rename_ignores_absent_names(spark):
    frame = spark.createDataFrame([(1.0, 2.0, "k")], "`PM2.5` double, `Wind-Speed (U)` double, other string")
    assert clean.rename_columns(frame).columns == ["pm2_5", "wind_speed_u", "other"]


def test_missing_columns_are_typed_nulls(spark):
    frame = spark.createDataFrame([(1.0,)], "pm10 double")
    added = clean.add_missing_columns(frame, SourceSpec("zaragoza", has_pm25=False, has_code_id=False))
    assert dict(added.dtypes) == {
        "pm10": "double", "pm2_5": "double", "code": "string", "id": "int", "city": "string",
    }
    assert tuple(added.first()) == (1.0, None, None, None, "zaragoza")
    assert clean.add_missing_columns(frame, SourceSpec("athens")).columns == ["pm10", "city"]


def test_fahrenheit_only_where_it_is_used(spark):
    frame = spark.createDataFrame(
        [("ancona", 32.0, 212.0, None), ("athens", 32.0, 212.0, 50.0)],
        "city string, dewpoint_temp double, soil_temp double, temp double",
    )
    assert [tuple(r) for r in clean.fahrenheit_to_celsius(frame).orderBy("city").collect()] == [
        ("ancona", 0.0, 100.0, None), ("athens", 32.0, 212.0, 50.0),
    ]
    assert clean.fahrenheit_to_celsius(frame, []) is frame


def test_unify_adds_drops_and_orders_columns(spark, rows):
    athens = spark.createDataFrame(
        [("2024-01-01 00:00:00", "S1", 5.0, 50.0, "c", 7, "extra")],
        "Date string, station_name string, `PM10` double, Temp double, code string, id int, remark string",
    )
    ancona = spark.createDataFrame(
        [("S2", 212.0, 1.0)], "station_name string, Temp double, `PM2.5` double"
    )
    unified = clean.unify_sources(
        [(SourceSpec("athens"), athens), (SourceSpec("ancona", temp_unit="fahrenheit"), ancona)]
    )
    assert unified.columns == [c for c in RAW_COLUMNS if c in unified.columns]
    assert "remark" not in unified.columns
    got = {r["city"]: r for r in unified.collect()}
    assert got["ancona"]["temp"] == 100.0 and got["ancona"]["pm10"] is None and got["ancona"]["date"] is None
    assert got["athens"]["temp"] == 50.0 and got["athens"]["id"] == 7


@pytest.mark.parametrize(
    "table, ratio",
    [
        ([("athens", 10.0, 4.0, None, None), ("ancona", 10.0, 8.0, None, None)], 0.6),
        ([("athens", 10.0, 4.0, None, None), ("zaragoza", 1.0, 9.0, None, None)], 0.4),
        ([("athens", 0.0, 4.0, None, None), ("athens", None, 4.0, None, None)], 0.5),
        ([], 0.5),
    ],
)
def test_ratio(spark, table, ratio):
    assert clean.pm25_ratio(spark.createDataFrame(table, SHAPE)).first()["ratio"] == pytest.approx(ratio)


def test_pm25_is_imputed_in_any_city(spark):
    table = [("athens", 10.0, 4.0, None, None), ("athens", 20.0, None, None, None),
             ("zaragoza", 5.0, None, None, None), ("ancona", None, None, 1.0, None)]
    got = clean.impute_pm25(spark.createDataFrame(table, SHAPE)).collect()
    assert [r["pm2_5"] for r in got] == [4.0, 8.0, 2.0, None]


def test_bad_dates_become_null(spark):
    frame = spark.createDataFrame([("2024-02-03 04:00:00",), ("soon",), (None,)], "date string")
    assert [r["date"] for r in clean.parse_timestamp(frame).collect()] == [datetime(2024, 2, 3, 4), None, None]


def test_rows_without_any_pollutant_go(spark):
    table = [("athens", None, None, None, None), ("athens", None, None, None, 0.0)]
    assert clean.drop_all_null(spark.createDataFrame(table, SHAPE)).count() == 1


def test_clean_imputes_before_it_drops_and_fills(spark):
    """Medians include imputed PM2.5; a column without values becomes 0."""
    weather = ", ".join(f"{c} double" for c in (
        "wind_speed_u wind_speed_v dewpoint_temp soil_temp total_percipitation vegetation_high vegetation_low temp "
        "relative_humidity").split())
    table = [
        ("bad date", "athens", 10.0, 5.0, 1.0, None) + (1.0,) * 9,
        ("2024-01-01 00:00:00", "zaragoza", 100.0, None, 3.0, None) + (3.0,) * 8 + (None,),
        ("2024-01-01 01:00:00", "athens", None, None, 3.0, None) + (None,) * 9,
        ("2024-01-01 02:00:00", "athens", None, None, None, None) + (9.0,) * 9,
    ]
    got = clean.clean(spark.createDataFrame(table, f"date string, {SHAPE}, {weather}")).collect()
    assert len(got) == 3
    by_no2 = {(r["city"], r["no2"], r["pm10"]): r for r in got}
    assert by_no2[("zaragoza", 3.0, 100.0)]["pm2_5"] == 50.0
    filled = by_no2[("athens", 3.0, 10.0)]
    assert filled["pm2_5"] == 5.0 and filled["o3"] == 0.0 and filled["temp"] == 1.0
    assert by_no2[("athens", 1.0, 10.0)]["date"] is None


def test_one_pass_when_the_statistics_are_given(spark):
    table = spark.createDataFrame([("athens", 10.0, None, None, None)], SHAPE)
    ratio = spark.createDataFrame([(0.25,)], "ratio double")
    assert clean.impute_pm25(table, ratio).first()["pm2_5"] == 2.5
