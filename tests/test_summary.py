import pytest
from pyspark.sql import functions as F

from stationflow.functions import (
    aqi_alert,
    aqi_description,
    aqi_label,
    aqi_level,
    aqi_level_by_key,
    capitalize_first,
    half_up,
)
from stationflow.operators import summary
from stationflow.operators.snapshot import snapshot_features, with_defaults
from stationflow.schemas import AQI_BOUNDS, CITY_LEVELS, LAGS, ROLLING, SEASON_LEVELS, SNAPSHOT_DEFAULTS


@pytest.fixture(scope="module")
def cities(spark):
    return spark.createDataFrame(
        [("athens", 30.0, 10.0, 60.0, 50.0, 2), ("ancona", 10.0, 40.0, 0.5, 70.0, 1), ("zaragoza", 20.0, 13.0, 0.25, 90.0, 3)],
        "city string, avg_pm10 double, avg_pm25 double, avg_no2 double, avg_o3 double, count bigint",
    )


def level_of(spark, key, value):
    frame = spark.createDataFrame([(value,)], "v double")
    return frame.select(aqi_level(key, F.col("v"))).first()[0]


@pytest.mark.parametrize("pollutant", list(AQI_BOUNDS))
def test_bounds_are_inclusive(spark, pollutant):
    bounds = AQI_BOUNDS[pollutant]
    levels = [*bounds, "hazardous"]
    values = [v for upper in bounds.values() for v in (upper, upper + 0.01)]
    frame = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r[0] for r in frame.select(aqi_level(pollutant, F.col("v"))).collect()]
    assert got == [level for pair in zip(levels, levels[1:]) for level in pair]


@pytest.mark.parametrize(
    "key, value, level",
    [("pm2_5", 12.0, "good"), ("avg_pm25", 12.1, "moderate"), ("pm25_prediction", 250.5, "hazardous"),
     ("pm10", float("nan"), "hazardous"), ("o3_prediction", None, None), ("no2_prediction", 9999.0, "good"),
     ("temp", None, "good"), ("pm10", -5.0, "good"), ("o3", float("inf"), "hazardous")],
)
def test_levels(spark, key, value, level):
    assert level_of(spark, key, value) == level
    frame = spark.createDataFrame([(key, value)], "k string, v double")
    assert frame.select(aqi_level_by_key(F.col("k"), F.col("v"))).first()[0] == level


def test_texts_and_alerts(spark):
    frame = spark.createDataFrame([("good",), ("moderate",), ("unhealthy_sensitive",), ("hazardous",), (None,)], "l string")
    level = F.col("l")
    got = frame.select(aqi_label(level), aqi_description(level), aqi_alert(level)).collect()
    assert [r[2] for r in got] == [False, False, True, True, None]
    assert got[2][0] == "Unhealthy for Sensitive Groups" and got[0][1] == "Air quality is safe" and got[4][0] is None


def test_rounding_and_capitals(spark):
    frame = spark.createDataFrame([(1.005, "new york"), (0.125, "éVORA"), (-0.125, ""), (None, None)], "v double, s string")
    assert [r[0] for r in frame.select(half_up(F.col("v"), 2)).collect()] == [1.01, 0.13, -0.13, None]
    assert [r[0] for r in frame.select(capitalize_first(F.col("s"))).collect()] == ["New york", "ÉVORA", "", None]


def test_city_summary(spark):
    table = [("a", 1.0, None, 2.0, 3.0), ("a", 1.01, None, None, 4.0), ("a", None, 7.0, None, None), (None, 1.0, 1.0, 1.0, 1.0)]
    frame = spark.createDataFrame(table, "city string, pm10 double, pm2_5 double, no2 double, o3 double")
    assert [tuple(r) for r in summary.city_summary(frame).collect()] == [("a", 1.01, 7.0, 2.0, 3.5, 2)]


def test_cross_city(cities):
    stats = {r["measure"]: r for r in summary.cross_city_stats(cities).collect()}
    assert stats["avg_pm10"]["mean"] == 20.0 and stats["avg_pm10"]["max"] == 30.0
    small = {r["measure"]: r for r in summary.cross_city_stats(cities.filter("city <> 'athens'")).collect()}
    assert small["avg_no2"]["max"] == 1.0
    share = {(r["city"], r["measure"]): r["share"] for r in summary.cross_city_share(cities).collect()}
    assert share[("ancona", "avg_pm25")] == 100.0 and share[("all", "avg_pm10")] == pytest.approx(200 / 3)
    assert len(share) == 16


def test_classified_summary(cities):
    got = {(r["city"], r["measure"]): r for r in summary.summary_aqi(cities).collect()}
    assert got[("zaragoza", "avg_o3")]["level"] == "unhealthy" and got[("zaragoza", "avg_o3")]["alert"]
    assert got[("all", "avg_o3")]["level"] == "moderate" and not got[("all", "avg_o3")]["alert"]
    assert len(got) == 16


def test_pivot_and_measures(cities):
    pivot = {r["pollutant"]: r for r in summary.radar_pivot(cities).collect()}
    assert set(pivot) == {"PM10", "PM2.5", "NO₂", "O₃"} and pivot["NO₂"]["Zaragoza"] == 0.3
    chosen = summary.select_measures(cities, ["avg_o3", "avg_pm10", "nothing"])
    assert {r["measure"] for r in chosen.collect()} == {"avg_o3", "avg_pm10"}


def test_profiles(spark):
    frame = spark.createDataFrame([("a", 1, None), ("a", None, None), ("b", 3, None)], "station_name string, date int, x int")
    assert [tuple(r) for r in summary.null_profile(frame).collect()] == [("x", 3), ("date", 1), ("station_name", 0)]
    assert summary.null_profile(frame, top=1).count() == 1 and summary.null_profile(frame, top=None).count() == 3
    assert tuple(summary.dataset_profile(frame).first()) == (3, 2, 1, 3, 3)
    assert summary.column_types(frame) == {"station_name": "string", "date": "int", "x": "int"}
    assert [tuple(r)[:2] for r in summary.preview(frame, 2).collect()] == [("a", None), ("a", 1)]


def test_snapshot_defaults(spark):
    filled = with_defaults(spark.createDataFrame([(None, 3)], "pm10 double, hour int")).first()
    assert filled["pm10"] == 10.0 and filled["hour"] == 3 and filled["city"] == "athens"
    assert set(SNAPSHOT_DEFAULTS) <= set(filled.asDict())


def test_snapshot_features(spark):
    frame = spark.createDataFrame(
        [(8.0, 0.0, -1.0, 3.0, 4.0, 7, "ancona", "winter", "k"), (8.0, 4.0, 2.0, 0.0, 0.0, 3, "paris", "fall", "l")],
        "pm10 double, pm2_5 double, o3 double, wind_speed_u double, wind_speed_v double, day_of_week int, city string, "
        "season string, key string",
    )
    features = snapshot_features(frame, keep=("key",))
    assert len(features.columns) == 52
    first, second = features.orderBy("key").collect()
    assert (first["year"], first["day"], first["wind_direction"], first["wind_speed"]) == (2020, 15, 0.0, 5.0)
    assert (first["pm10_pm25_ratio"], first["no2_o3_balance"], first["is_weekend"]) == (0.0, 0.0, 1)
    assert (second["pm10_pm25_ratio"], second["no2_o3_balance"], second["is_weekend"]) == (2.0, 5.0, 0)
    assert all(second[c] == {"pm10": 8.0, "pm25": 4.0, "no2": 10.0, "o3": 2.0}[c.split("_")[0]] for c in [*ROLLING, *LAGS])
    assert [first[f"city_{c}"] for c in CITY_LEVELS] == [1, 0, 0] and sum(second[f"city_{c}"] for c in CITY_LEVELS) == 0
    assert [first[f"season_{s}"] for s in SEASON_LEVELS] == [0, 0, 0, 1]


def test_snapshot_inputs_match_the_training_inputs(spark):
    """A model trained on the ML table finds every one of its inputs in a snapshot."""
    from stationflow.operators.matrix import CATEGORIES, IDENTIFIERS
    from stationflow.schemas import ML_COLUMNS, TARGETS

    trained = {c for c in ML_COLUMNS if c not in (*TARGETS, *IDENTIFIERS, *CATEGORIES)}
    trained |= {f"{c}_{v}" for c, levels in CATEGORIES.items() for v in levels}
    assert set(snapshot_features(spark.createDataFrame([(1.0,)], "pm10 double")).columns) == trained and len(trained) == 51
