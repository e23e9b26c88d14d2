"""Health bands of pollutant values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import AQI_ABOVE, AQI_ALIASES, AQI_BOUNDS, AQI_CALM, AQI_TEXT, AQI_UNKNOWN_KEY


def _pollutant(key: str) -> str | None:
    return next((p for p, names in AQI_ALIASES.items() if key in names), None)


def aqi_level(key: str, value: Column) -> Column:
    """Band of ``value`` for a known measure name: null for null, hazardous for NaN, good for an unknown name."""
    pollutant = _pollutant(key)
    if pollutant is None:
        return F.lit(AQI_UNKNOWN_KEY)
    bands = F.when(value.isNull(), F.lit(None).cast("string"))
    for level, upper in AQI_BOUNDS[pollutant].items():
        bands = bands.when(value <= upper, level)
    return bands.otherwise(AQI_ABOVE)


def aqi_level_by_key(key: Column, value: Column) -> Column:
    """As :func:`aqi_level`, with the measure name in a column."""
    level = F
    for pollutant, names in AQI_ALIASES.items():
        level = level.when(key.isin(names), aqi_level(pollutant, value))
    return level.otherwise(AQI_UNKNOWN_KEY)


def _text(level: Column, part: int) -> Column:
    text = F
    for name, texts in AQI_TEXT.items():
        text = text.when(level == name, texts[part])
    return text.otherwise(F.lit(None).cast("string"))


def aqi_label(level: Column) -> Column:
    return _text(level, 0)


def aqi_description(level: Column) -> Column:
    return _text(level, 1)


def aqi_alert(level: Column) -> Column:
    """True for every band worse than moderate."""
    return ~level.isin(AQI_CALM)
