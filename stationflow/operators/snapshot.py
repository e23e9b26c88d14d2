"""Features for single readings that come without history."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import guarded_ratio, is_weekend, wind_speed
from ..schemas import CITY_LEVELS, LAGS, POLLUTANTS, ROLLING, SEASON_LEVELS, SNAPSHOT_DAY, SNAPSHOT_DEFAULTS, SNAPSHOT_YEAR


def with_defaults(df: DataFrame, defaults: dict = SNAPSHOT_DEFAULTS) -> DataFrame:
    """Fill every input field: missing columns and missing values take the default."""

    def field(name: str, default) -> Column:
        return F.coalesce(F.col(name), F.lit(default)) if name in df.columns else F.lit(default)

    return df.withColumns({name: field(name, default) for name, default in defaults.items()})


def snapshot_inputs(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The model inputs of each reading before encoding (``city`` and ``season`` as text), plus the columns in ``keep``.

    Rolling and lagged values repeat the reading itself; ratios are 0 where the divisor is not positive. Columns of
    ``keep`` that are inputs too are there once.
    """
    filled = with_defaults(df)
    now = {p.replace("pm2_5", "pm25"): F.col(p) for p in POLLUTANTS}
    repeated = {name: now[name.split("_")[0]] for name in [*ROLLING, *LAGS]}
    reading = [c for c in SNAPSHOT_DEFAULTS if c not in ("city", "season", "month", "hour", "day_of_week")]
    inputs = {
        **{c: F.col(c) for c in reading},
        "year": F.lit(SNAPSHOT_YEAR),
        "month": F.col("month"),
        "day": F.lit(SNAPSHOT_DAY),
        "hour": F.col("hour"),
        "day_of_week": F.col("day_of_week"),
        "is_weekend": is_weekend(F.col("day_of_week")),
        "wind_speed": wind_speed(F.col("wind_speed_u"), F.col("wind_speed_v")),
        "wind_direction": F.lit(0.0),
        "temp_dewpoint_spread": F.col("temp") - F.col("dewpoint_temp"),
        "temp_soil_diff": F.col("temp") - F.col("soil_temp"),
        "pm10_pm25_ratio": guarded_ratio(F.col("pm10"), F.col("pm2_5"), 0.0),
        "no2_o3_balance": guarded_ratio(F.col("no2"), F.col("o3"), 0.0),
        **repeated,
        "city": F.col("city"),
        "season": F.col("season"),
    }
    return filled.select(*[c for c in keep if c not in inputs], *[e.alias(c) for c, e in inputs.items()])


def snapshot_features(
    df: DataFrame,
    keep: tuple[str, ...] = (),
    cities: Sequence[str] = CITY_LEVELS,
    seasons: Sequence[str] = SEASON_LEVELS,
) -> DataFrame:
    """:func:`snapshot_inputs` with one 0/1 column per city and season in place of the two."""
    inputs = snapshot_inputs(df, keep)
    return inputs.select(
        *[c for c in inputs.columns if c not in ("city", "season")],
        *[(F.col("city") == c).cast("int").alias(f"city_{c}") for c in cities],
        *[(F.col("season") == s).cast("int").alias(f"season_{s}") for s in seasons],
    )
