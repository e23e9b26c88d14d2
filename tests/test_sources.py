from datetime import datetime

import pytest
from pyspark.sql import functions as F

from stationflow.schemas import ML_SCHEMA, RAW_SCHEMA, SourceSpec
from stationflow.session import get_session
from stationflow.sources import (
    check_schema,
    connection_properties,
    create_tables,
    read_csv,
    read_dataset,
    read_source,
    replace_cities,
    shared_dir,
    staged,
    wide_rows,
    write_csv,
    write_metrics,
    write_parquet,
)
from stationflow.sources.jdbc import read_options, write_options

PROPERTIES = {"url": "jdbc:x", "user": "u", "password": "p", "driver": "d"}


def test_csv_types_follow_the_header_whatever_its_order(spark, tmp_path):
    path = tmp_path / "city.csv"
    path.write_text("PM10,remark,id,Date,station_name\n1.5,x,7,2024-01-01 00:00:00,S1\nbad,y,z,nonsense,S2\n")
    frame = read_source(spark, SourceSpec("athens", str(path)))
    assert dict(frame.dtypes) == {"PM10": "double", "remark": "string", "id": "int", "Date": "string", "station_name": "string"}
    assert [tuple(r) for r in frame.collect()] == [
        (1.5, "x", 7, "2024-01-01 00:00:00", "S1"), (None, "y", None, "nonsense", "S2"),
    ]
    assert dict(read_csv(spark, str(path), infer=True).dtypes)["PM10"] == "string"


def test_datasets_in_part_files(spark, tmp_path):
    table = spark.createDataFrame([(datetime(2024, 1, i + 1), f"S{i}", i * 0.1, i) for i in range(9)],
                                  "date timestamp, station_name string, pm10 double, hour int").repartition(3)
    write_csv(table, str(tmp_path / "t.csv"))
    write_csv(table, str(tmp_path / "one.csv"), files=1)
    write_parquet(table, str(tmp_path / "t.parquet"))
    write_parquet(table, str(tmp_path / "plain"), partition_by=["station_name"])
    write_csv(table, str(tmp_path / "text"))
    expected = sorted(map(tuple, table.collect()))
    for name in ("t.csv", "one.csv", "t.parquet", "text"):
        got = read_dataset(spark, str(tmp_path / "absent.parquet"), str(tmp_path / name))
        assert got.dtypes == table.dtypes and sorted(map(tuple, got.collect())) == expected, name
    plain = read_dataset(spark, str(tmp_path / "plain")).select(*table.columns)
    assert sorted(map(tuple, plain.collect())) == expected
    assert len(list((tmp_path / "one.csv").glob("part-*"))) == 1
    assert len(list((tmp_path / "t.csv").glob("part-*"))) == 3


def test_missing_dataset_is_named(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="absent.parquet"):
        read_dataset(spark, str(tmp_path / "absent.parquet"), str(tmp_path / "absent.csv"))


def test_staged_tables_go_to_the_shared_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    assert shared_dir(spark, "t").startswith(base) and shared_dir(spark, "t") != shared_dir(spark, "t")
    table = spark.range(5).selectExpr("id", "id % 2 as k")
    stored = staged(table, "numbers", ["k"])
    assert sorted(map(tuple, stored.select("id", "k").collect())) == [(i, i % 2) for i in range(5)]
    assert all(f.startswith("file:") and "/numbers-" in f for f in stored.inputFiles())


def test_metrics_lines(spark, tmp_path):
    metrics = spark.createDataFrame([("pm25", 1.0), ("o3", 12.34567)], "target string, rmse double")
    write_metrics(metrics, str(tmp_path / "metrics.txt"))
    assert [r[0] for r in spark.read.text(str(tmp_path / "metrics.txt")).collect()] == ["o3: RMSE=12.3457", "pm25: RMSE=1.0000"]


def test_tables(spark):
    create_tables(spark)
    create_tables(spark)
    assert {f.name: f.dataType for f in spark.table("raw.air_quality").schema} == {f.name: f.dataType for f in RAW_SCHEMA}
    assert {f.name: f.dataType for f in spark.table("ml.air_quality_ready").schema} == {f.name: f.dataType for f in ML_SCHEMA}


CITIES = "city string, date timestamp, pm10 double"


def city_rows(spark, values):
    return spark.createDataFrame([(c, datetime(2024, 1, 1, h), float(v)) for c, h, v in values], CITIES)


def test_a_rerun_replaces_its_cities_only(spark, rows, tmp_path):
    name = "rerun_cities"
    first = city_rows(spark, [("a", 0, 1), ("a", 1, 2), ("b", 0, 3), (None, 0, 4)])
    create_tables(spark, {name: first.schema}, {name: str(tmp_path / name)})
    mode = spark.conf.get("spark.sql.sources.partitionOverwriteMode")

    def held():
        return rows(spark.table(name).select("city", F.hour("date"), "pm10"))

    replace_cities(first, name)
    assert held() == [(None, 0, 4.0), ("a", 0, 1.0), ("a", 1, 2.0), ("b", 0, 3.0)]
    again = city_rows(spark, [("a", 5, 9), ("c", 0, 7)]).select("pm10", "city", "date")
    for _ in range(2):  # a repeated run changes nothing more
        replace_cities(again, name)
        assert held() == [(None, 0, 4.0), ("a", 5, 9.0), ("b", 0, 3.0), ("c", 0, 7.0)]
    replace_cities(city_rows(spark, [(None, 2, 8)]), name, balance=False)
    replace_cities(first.limit(0), name)
    assert held() == [(None, 2, 8.0), ("a", 5, 9.0), ("b", 0, 3.0), ("c", 0, 7.0)]
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == mode


def test_a_failed_write_leaves_the_table(spark, rows, tmp_path):
    name = "failed_cities"
    table = city_rows(spark, [("a", 0, 1), ("b", 0, 2)])
    create_tables(spark, {name: table.schema}, {name: str(tmp_path / name)})
    replace_cities(table, name)
    broken = table.withColumn("pm10", F.when(F.col("city") == "b", F.raise_error("broken")).otherwise(F.col("pm10") + 1))
    with pytest.raises(Exception, match="broken"):
        replace_cities(broken.withColumn("pm10", F.col("pm10").cast("double")), name)
    assert rows(spark.table(name)) == rows(table.select("date", "pm10", "city"))


def test_rows_that_do_not_fit_a_table_are_refused(spark):
    table = city_rows(spark, [("a", 0, 1)])
    check_schema(table.select("pm10", "date", "city"), table.schema, "t")
    wrong = table.drop("date").withColumns({"pm10": F.lit("x"), "extra": F.lit(1)})
    with pytest.raises(ValueError, match="t: date is missing, extra is not in the table, pm10 is string, not double"):
        check_schema(wrong, table.schema, "t")
    with pytest.raises(ValueError, match="city is there twice"):
        check_schema(table.select("*", "city"), table.schema, "t")


def test_jdbc_options():
    """Options only: no database is opened."""
    plain = read_options("raw.t", PROPERTIES)
    assert plain["dbtable"] == "raw.t" and "partitionColumn" not in plain
    parts = read_options("raw.t", PROPERTIES, partition_column="date", lower="2020", upper="2024", partitions=16)
    assert (parts["partitionColumn"], parts["lowerBound"], parts["upperBound"], parts["numPartitions"]) == ("date", "2020", "2024", "16")
    with pytest.raises(ValueError, match="bounds"):
        read_options("raw.t", PROPERTIES, partition_column="date")
    written = write_options("ml.t", PROPERTIES)
    assert (written["batchsize"], written["truncate"]) == ("10000", "true") and "numPartitions" not in written
    assert write_options("ml.t", PROPERTIES, connections=4)["numPartitions"] == "4"


def test_connection_has_no_default_password(monkeypatch):
    for name in ("POSTGRES_URL", "POSTGRES_USER", "POSTGRES_PASSWORD"):
        monkeypatch.delenv(name, raising=False)
    monkeypatch.setenv("POSTGRES_URL", "jdbc:x")
    monkeypatch.setenv("POSTGRES_USER", "u")
    with pytest.raises(ValueError, match="POSTGRES_PASSWORD"):
        connection_properties()
    monkeypatch.setenv("POSTGRES_PASSWORD", "p")
    assert connection_properties()["password"] == "p"


def test_session_settings(spark, monkeypatch):
    monkeypatch.delenv("SPARK_MASTER_URL", raising=False)
    session = get_session("again")
    assert session.conf.get("spark.sql.adaptive.enabled") == "true"
    assert session.conf.get("spark.sql.session.timeZone") == "UTC"


def test_staged_with_a_codec(spark):
    df = spark.range(100).selectExpr("id", "repeat('words ', 50) text")
    stored = staged(df, "codec", compression="zstd")
    assert stored.exceptAll(df).isEmpty() and stored.count() == 100
    assert all(".zstd." in f for f in stored.inputFiles())


def test_wide_tables_are_written_operator_by_operator(spark):
    """One method for all columns would be too large for the JVM to compile."""
    setting = "spark.sql.codegen.wholeStage"
    before, seen = spark.conf.get(setting), []
    frame = spark.range(9).select(*[(F.col("id") + i).alias(f"c{i}") for i in range(60)])
    with wide_rows(spark):
        seen.append(frame.filter("c59 > 60")._jdf.queryExecution().executedPlan().toString())
    assert "*(" not in seen[0] and spark.conf.get(setting) == before
    written = staged(frame, "wide", wide=True)
    assert sorted(written.collect()) == sorted(frame.collect()) and spark.conf.get(setting) == before
    with pytest.raises(ZeroDivisionError), wide_rows(spark):
        1 / 0
    assert spark.conf.get(setting) == before
