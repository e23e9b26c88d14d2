import math
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from stationflow.operators import features
from stationflow.plans import build_ml_dataset
from stationflow.plans.ml_dataset import ml_features
from stationflow.schemas import ML_COLUMNS, ML_SCHEMA, POLLUTANTS, RAW_SCHEMA, WEATHER

START = datetime(2024, 1, 1)


def station(name, n, **values):
    base = dict(latitude=1.0, longitude=2.0, code="c", id=1, city="athens", **{c: 2.0 for c in WEATHER})
    for i in range(n):
        row = {**base, "station_name": name, "date": START + timedelta(hours=i), **{p: float(i + 1) for p in POLLUTANTS}}
        yield tuple({**row, **values}[c] for c in RAW_SCHEMA.names)


def raw(spark, sizes, **values):
    return spark.createDataFrame([r for name, n in sizes.items() for r in station(name, n, **values)], RAW_SCHEMA)


def test_layout():
    assert len(RAW_SCHEMA.names) == 20 and len(ML_COLUMNS) == 51
    assert len(set(ML_COLUMNS)) == 51


@pytest.mark.parametrize(
    "month, season", [(12, "winter"), (1, "winter"), (3, "spring"), (5, "spring"), (6, "summer"), (8, "summer"), (9, "fall")]
)
def test_season(spark, month, season):
    frame = spark.createDataFrame([(datetime(2024, month, 15, 7),)], "date timestamp")
    got = features.temporal_features(frame).first()
    assert (got["year"], got["month"], got["day"], got["hour"], got["season"]) == (2024, month, 15, 7, season)


def test_weekend_and_missing_date(spark):
    days = [datetime(2024, 1, 6), datetime(2024, 1, 7), datetime(2024, 1, 8), None]
    got = features.temporal_features(spark.createDataFrame([(d,) for d in days], "date timestamp")).collect()
    assert [(r["day_of_week"], r["is_weekend"], r["season"]) for r in got] == [
        (7, 1, "winter"), (1, 1, "winter"), (2, 0, "winter"), (None, 0, "fall"),
    ]


@pytest.mark.parametrize("u, v, degrees", [(1, 0, 0), (0, 1, 90), (-1, 0, 180), (0, -1, -90)])
def test_wind(spark, u, v, degrees):
    frame = spark.createDataFrame(
        [(float(u), float(v), 3.0, 1.0, 5.0)],
        "wind_speed_u double, wind_speed_v double, temp double, dewpoint_temp double, soil_temp double",
    )
    got = features.weather_features(frame).first()
    assert got["wind_direction"] == pytest.approx(degrees) and got["wind_speed"] == 1.0
    assert (got["temp_dewpoint_spread"], got["temp_soil_diff"]) == (2.0, -2.0)


def test_ratios_need_a_positive_divisor(spark):
    frame = spark.createDataFrame(
        [(4.0, 2.0, 3.0, 6.0), (4.0, 0.0, 3.0, -1.0), (4.0, None, None, 6.0)],
        "pm10 double, pm2_5 double, no2 double, o3 double",
    )
    got = [(r["pm10_pm25_ratio"], r["no2_o3_balance"]) for r in features.pollutant_ratios(frame).collect()]
    assert got == [(2.0, 0.5), (None, None), (None, None)]


def test_windows_count_rows_not_hours(spark):
    table = raw(spark, {"A": 30}).withColumn(
        "date", F.when(F.col("pm10") > 15, F.expr("date + interval 90 days")).otherwise(F.col("date"))
    )
    got = {r["pm10"]: r for r in features.window_features(table).collect()}
    for i in range(1, 31):
        back, ahead = list(range(max(1, i - 23), i + 1)), list(range(i + 1, min(30, i + 24) + 1))
        assert got[i]["pm10_roll_24h_mean"] == pytest.approx(sum(back) / len(back))
        assert got[i]["o3_roll_24h_max"] == i
        assert got[i]["no2_lag3"] == (i - 3 if i > 3 else None)
        assert got[i]["pm25_next_24h_mean"] == (pytest.approx(sum(ahead) / len(ahead)) if ahead else None)
        assert got[i]["o3_next_24h_max"] == (ahead[-1] if ahead else None)


def test_short_stations_leave_n_minus_4_rows(spark):
    sizes = {"A": 1, "B": 3, "C": 4, "D": 5, "E": 40}
    dataset = build_ml_dataset(raw(spark, sizes))
    assert dataset.schema.names == ML_SCHEMA.names
    assert [f.dataType for f in dataset.schema] == [f.dataType for f in ML_SCHEMA]
    assert {r["station_name"]: r["count"] for r in dataset.groupBy("station_name").count().collect()} == {"D": 1, "E": 36}


def test_order_and_partitioning_do_not_matter(spark, rows):
    table = raw(spark, {"A": 40, "B": 30})
    expected = rows(build_ml_dataset(table))
    assert rows(build_ml_dataset(table.orderBy(F.rand(5)).repartition(7))) == expected
    assert rows(build_ml_dataset(table.coalesce(1), rows_per_block=6)) == expected


def test_zero_divisors_drop_rows(spark):
    assert build_ml_dataset(raw(spark, {"A": 30}, pm2_5=0.0)).count() == 0
    assert build_ml_dataset(raw(spark, {"A": 30}, o3=0.0)).count() == 0


def test_one_shuffle_and_no_python(spark, tmp_path):
    raw(spark, {"A": 40}).write.parquet(str(tmp_path / "raw"))
    dataset = build_ml_dataset(spark.read.parquet(str(tmp_path / "raw")))
    plan = dataset._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "hashpartitioning(station_name" in plan
    assert plan.count("Window [") == 1 and "Python" not in plan
    assert "code" not in plan.split("ReadSchema")[1]


def test_accounting(spark):
    frame = spark.createDataFrame([(1, 2), (1, None), (None, None), (4, 5)], "a int, b int")
    assert tuple(features.drop_accounting(frame).first()) == (4, 2, 2, 50.0)
    assert features.drop_nulls(frame).count() == 2 and features.drop_nulls(frame, ["a"]).count() == 3
    assert tuple(features.drop_accounting(frame.limit(0)).first()) == (0, 0, 0, 0.0)


def test_missing_optional_columns_are_left_out(spark):
    table = raw(spark, {"A": 30}).drop("vegetation_high", "vegetation_low")
    assert ml_features(table).columns == [c for c in ML_COLUMNS if not c.startswith("vegetation")]


def test_row_features_on_a_stream(spark, tmp_path):
    """Row-wise operators take a streaming frame as it is."""
    raw(spark, {"A": 5}).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(RAW_SCHEMA).parquet(str(tmp_path / "in"))
    shaped = stream.transform(features.temporal_features).transform(features.weather_features).transform(
        features.pollutant_ratios
    )
    query = shaped.writeStream.format("memory").queryName("shaped").option(
        "checkpointLocation", str(tmp_path / "checkpoint")
    ).trigger(availableNow=True).start()
    query.awaitTermination(60)
    got = spark.table("shaped")
    assert got.count() == 5 and math.isclose(got.first()["wind_speed"], math.sqrt(8))
