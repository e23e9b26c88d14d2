"""Station readings derived from the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import COLUMN_MAP, SourceSpec

SOURCES = {
    "athens": SourceSpec("athens"),
    "ancona": SourceSpec("ancona", temp_unit="fahrenheit"),
    "zaragoza": SourceSpec("zaragoza", has_pm25=False, has_code_id=False),
}


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per station and hour, from ``events``."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    station, k = F.col("st"), F.col("k")

    def value_of(event_type: str):
        return F.max(F.when(F.col("event_type") == event_type, F.col("value")))

    hourly = events.groupBy(
        F.floor(F.col("user_id") / 10).cast("bigint").alias("st"),
        F.date_trunc("hour", "ts").cast("timestamp").alias("date"),
    ).agg(
        F.max(F.get_json_object("props", "$.k").cast("bigint")).alias("k"),
        value_of("click").alias("pm10"),
        value_of("view").alias("seen"),
        value_of("purchase").alias("no2"),
        value_of("error").alias("o3"),
    )

    def number(expression) -> object:
        return expression.cast("double")

    return hourly.select(
        "date",
        number(37.0 + station % 5).alias("latitude"),
        number(13.0 + station % 7).alias("longitude"),
        F.concat(F.lit("S"), station.cast("string")).alias("station_name"),
        number(k % 21 - 10).alias("wind_speed_u"),
        number(k % 13 - 6).alias("wind_speed_v"),
        number(k % 25).alias("dewpoint_temp"),
        F.when(k % 11 != 0, number(k % 17)).alias("soil_temp"),
        number(k % 3).alias("total_percipitation"),
        number(k % 5).alias("vegetation_high"),
        number(k % 4).alias("vegetation_low"),
        number(k % 31).alias("temp"),
        number(k).alias("relative_humidity"),
        "pm10",
        F.when(station % 3 != 2, F.col("seen")).alias("pm2_5"),
        "no2",
        "o3",
        F.when(station % 3 == 0, "athens").when(station % 3 == 1, "ancona").otherwise("zaragoza").alias("city"),
    )


DENSE_ORDER = ("date", "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice")


def readings_dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per line item; order by ``DENSE_ORDER`` for a definite row order within a station."""
    items = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    flag = F.col("l_returnflag")
    return items.select(
        F.col("l_shipdate").cast("timestamp").alias("date"),
        F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("station_name"),
        F.when(flag == "A", "athens").when(flag == "N", "ancona").otherwise("zaragoza").alias("city"),
        F.col("l_quantity").alias("pm10"),
        F.when(flag != "R", F.floor(F.col("l_extendedprice") / 1000).cast("double")).alias("pm2_5"),
        F.round(F.col("l_discount") * 100).alias("no2"),
        F.when(
            ~((F.col("l_linestatus") == "F") & (F.col("l_tax") == 0)), F.round(F.col("l_tax") * 100)
        ).alias("o3"),
        *DENSE_ORDER[1:],
    )


def city_sources(spark: SparkSession, sf_dir: str) -> list[tuple[SourceSpec, DataFrame]]:
    """The readings as three differently shaped sources: own headers, extra and missing columns, text dates."""
    headers = {canonical: header for header, canonical in COLUMN_MAP.items()}
    table = readings(spark, sf_dir)
    shaped = table.withColumn("date", F.date_format("date", "yyyy-MM-dd HH:mm:ss"))
    digits = F.substr("station_name", F.lit(2))

    def of(city: str) -> DataFrame:
        return shaped.filter(F.col("city") == city).drop("city")

    athens = of("athens").withColumns(
        {"code": F.concat(F.lit("C"), digits), "id": digits.cast("int"), "remark": F.lit("unlisted")}
    )
    zaragoza = of("zaragoza").drop("pm2_5", "vegetation_high", "vegetation_low")
    frames = {"athens": athens, "ancona": of("ancona"), "zaragoza": zaragoza}
    return [(SOURCES[city], frame.withColumnsRenamed(headers)) for city, frame in frames.items()]
