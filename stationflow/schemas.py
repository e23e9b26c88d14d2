"""Table layouts and fixed values shared by the whole package."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# --- Fixed values: column names, source headers, city settings -------------

POLLUTANTS = ["pm10", "pm2_5", "no2", "o3"]

WEATHER = [
    "wind_speed_u", "wind_speed_v", "dewpoint_temp", "soil_temp",
    "total_percipitation", "vegetation_high", "vegetation_low", "temp", "relative_humidity",
]

TEMPERATURES = ["dewpoint_temp", "soil_temp", "temp"]

RAW_COLUMNS = ["date", "latitude", "longitude", "station_name", *WEATHER, *POLLUTANTS, "code", "id", "city"]

CALENDAR = ["year", "month", "day", "hour", "day_of_week", "is_weekend"]
WEATHER_DERIVED = ["wind_speed", "wind_direction", "temp_dewpoint_spread", "temp_soil_diff"]
RATIOS = ["pm10_pm25_ratio", "no2_o3_balance"]
ROLLING = [
    "pm10_roll_24h_mean", "pm25_roll_24h_mean", "no2_roll_24h_mean", "o3_roll_24h_mean", "o3_roll_24h_max",
]
LAGS = [f"{p}_lag{n}" for p in ("pm10", "pm25", "no2", "o3") for n in (1, 2, 3)]
TARGETS = ["pm10_next_24h_mean", "pm25_next_24h_mean", "o3_next_24h_max"]

ML_COLUMNS = [
    "date", "latitude", "longitude", "station_name", "city",
    *WEATHER, *POLLUTANTS, *CALENDAR, "season",
    *WEATHER_DERIVED, *RATIOS, *ROLLING, *LAGS, *TARGETS,
]

# Columns filled with their median while cleaning.
IMPUTED = [*POLLUTANTS, *WEATHER]

# Source header -> canonical name, in the spelling the sources use.
COLUMN_MAP = {
    "Date": "date",
    "Latitude": "latitude",
    "Longitude": "longitude",
    "Wind-Speed (U)": "wind_speed_u",
    "Wind-Speed (V)": "wind_speed_v",
    "Dewpoint Temp": "dewpoint_temp",
    "Soil Temp": "soil_temp",
    "Total Percipitation": "total_percipitation",
    "Vegitation (High)": "vegetation_high",
    "Vegitation (Low)": "vegetation_low",
    "Relative Humidity": "relative_humidity",
    "Temp": "temp",
    "PM10": "pm10",
    "PM2.5": "pm2_5",
    "NO2": "no2",
    "O3": "o3",
}

CITY_LEVELS = ["ancona", "athens", "zaragoza"]
SEASON_LEVELS = ["fall", "spring", "summer", "winter"]

# Cities whose rows define the PM2.5 : PM10 ratio, and the ratio used when they have none.
RATIO_CITIES = ["athens", "ancona"]
DEFAULT_RATIO = 0.5

# Snapshot input fields and their defaults.
SNAPSHOT_DEFAULTS = {
    "latitude": 38.15,
    "longitude": 23.55,
    "wind_speed_u": 0.0,
    "wind_speed_v": 0.0,
    "dewpoint_temp": 10.0,
    "soil_temp": 17.0,
    "total_percipitation": 0.0,
    "vegetation_high": 1.7,
    "vegetation_low": 1.5,
    "temp": 14.0,
    "relative_humidity": 80.0,
    "pm10": 10.0,
    "pm2_5": 6.0,
    "no2": 10.0,
    "o3": 70.0,
    "city": "athens",
    "season": "spring",
    "hour": 12,
    "day_of_week": 1,
    "month": 5,
}
SNAPSHOT_YEAR = 2020
SNAPSHOT_DAY = 15

# Model names of the three targets.
TARGET_NAMES = {"pm10_next_24h_mean": "pm10", "pm25_next_24h_mean": "pm25", "o3_next_24h_max": "o3"}

# Health bands: inclusive upper bounds per pollutant, hazardous above the last one.
AQI_BOUNDS = {
    "pm2_5": {
        "good": 12.0, "moderate": 35.4, "unhealthy_sensitive": 55.4, "unhealthy": 150.4, "very_unhealthy": 250.4,
    },
    "pm10": {"good": 54.0, "moderate": 154.0, "unhealthy_sensitive": 254.0, "unhealthy": 354.0, "very_unhealthy": 424.0},
    "no2": {"good": 53.0, "moderate": 100.0, "unhealthy_sensitive": 360.0, "unhealthy": 649.0, "very_unhealthy": 1249.0},
    "o3": {"good": 54.0, "moderate": 70.0, "unhealthy_sensitive": 85.0, "unhealthy": 105.0, "very_unhealthy": 200.0},
}
AQI_ABOVE = "hazardous"
AQI_UNKNOWN_KEY = "good"
AQI_CALM = ["good", "moderate"]

AQI_ALIASES = {
    "pm2_5": ["avg_pm25", "pm2_5", "pm25_prediction"],
    "pm10": ["avg_pm10", "pm10", "pm10_prediction"],
    "no2": ["avg_no2", "no2"],
    "o3": ["avg_o3", "o3", "o3_prediction"],
}

AQI_TEXT = {
    "good": ("Good", "Air quality is safe"),
    "moderate": ("Moderate", "Air quality is acceptable"),
    "unhealthy_sensitive": ("Unhealthy for Sensitive Groups", "Sensitive groups should limit outdoor activity"),
    "unhealthy": ("Unhealthy", "Everyone should limit outdoor activity"),
    "very_unhealthy": ("Very Unhealthy", "Health alert — everyone may experience effects"),
    "hazardous": ("Hazardous", "Health emergency — avoid all outdoor activity"),
}

# Summary measures and their display names.
SUMMARY_MEASURES = {"avg_pm10": "PM10", "avg_pm25": "PM2.5", "avg_no2": "NO₂", "avg_o3": "O₃"}

# --- Schemas ---------------------------------------------------------------

_TYPES = {
    "date": TimestampType(),
    **dict.fromkeys(["station_name", "city", "code", "season"], StringType()),
    **dict.fromkeys(["id", *CALENDAR], IntegerType()),
}


def type_of(column: str):
    """Spark type of a canonical or ML column; measurements are doubles."""
    return _TYPES.get(column, DoubleType())


def _schema(columns: list[str]) -> StructType:
    return StructType([StructField(c, type_of(c)) for c in columns])


RAW_SCHEMA = _schema(RAW_COLUMNS)
ML_SCHEMA = _schema(ML_COLUMNS)


@dataclass(frozen=True)
class SourceSpec:
    """One input: where it is, which city it describes and how it differs from the canonical form."""

    city: str
    path: str = ""
    has_pm25: bool = True
    has_code_id: bool = True
    temp_unit: str = "celsius"


def default_sources(data_dir: str) -> list[SourceSpec]:
    """The three city files below ``data_dir``."""
    return [
        SourceSpec("athens", f"{data_dir}/athens_data.csv"),
        SourceSpec("ancona", f"{data_dir}/ancona_data.csv", temp_unit="fahrenheit"),
        SourceSpec("zaragoza", f"{data_dir}/zaragoza_data.csv", has_pm25=False, has_code_id=False),
    ]
