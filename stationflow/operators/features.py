"""Calendar, weather, ratio and row-window features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from ..functions import guarded_ratio, is_weekend, missing, season, wind_direction, wind_speed
from ..schemas import POLLUTANTS
from .blocks import ROWS_PER_BLOCK, with_row_frames

STATION = ("station_name",)
WINDOW_ROWS = 24
LAG_ROWS = (1, 2, 3)

# Output names shorten pm2_5 to pm25.
_SHORT = {p: p.replace("pm2_5", "pm25") for p in POLLUTANTS}


def temporal_features(df: DataFrame) -> DataFrame:
    """Calendar parts of ``date``, weekend flag and season."""
    date = F.col("date")
    return df.withColumns(
        {
            "year": F.year(date),
            "month": F.month(date),
            "day": F.dayofmonth(date),
            "hour": F.hour(date),
            "day_of_week": F.dayofweek(date),
            "is_weekend": is_weekend(F.dayofweek(date)),
            "season": season(F.month(date)),
        }
    )


def weather_features(df: DataFrame) -> DataFrame:
    u, v, temp = F.col("wind_speed_u"), F.col("wind_speed_v"), F.col("temp")
    return df.withColumns(
        {
            "wind_speed": wind_speed(u, v),
            "wind_direction": wind_direction(u, v),
            "temp_dewpoint_spread": temp - F.col("dewpoint_temp"),
            "temp_soil_diff": temp - F.col("soil_temp"),
        }
    )


def pollutant_ratios(df: DataFrame) -> DataFrame:
    """PM10 : PM2.5 and NO2 : O3, null unless the divisor is positive."""
    return df.withColumns(
        {
            "pm10_pm25_ratio": guarded_ratio(F.col("pm10"), F.col("pm2_5")),
            "no2_o3_balance": guarded_ratio(F.col("no2"), F.col("o3")),
        }
    )


def rolling_columns(ordered: WindowSpec) -> dict[str, Column]:
    """Means of the four pollutants and the O3 maximum over the last 24 rows, this one included."""
    frame = ordered.rowsBetween(1 - WINDOW_ROWS, 0)
    means = {f"{short}_roll_24h_mean": F.avg(p).over(frame) for p, short in _SHORT.items()}
    return {**means, "o3_roll_24h_max": F.max("o3").over(frame)}


def lag_columns(ordered: WindowSpec) -> dict[str, Column]:
    return {f"{short}_lag{n}": F.lag(p, n).over(ordered) for p, short in _SHORT.items() for n in LAG_ROWS}


def target_columns(ordered: WindowSpec) -> dict[str, Column]:
    """What the next 24 rows bring: PM10 and PM2.5 means, O3 maximum."""
    frame = ordered.rowsBetween(1, WINDOW_ROWS)
    return {
        "pm10_next_24h_mean": F.avg("pm10").over(frame),
        "pm25_next_24h_mean": F.avg("pm2_5").over(frame),
        "o3_next_24h_max": F.max("o3").over(frame),
    }


def rolling_features(
    df: DataFrame, order: Sequence[str] = ("date",), rows_per_block: int | None = ROWS_PER_BLOCK
) -> DataFrame:
    return with_row_frames(df, rolling_columns, WINDOW_ROWS - 1, 0, STATION, order, rows_per_block)


def lag_features(
    df: DataFrame, order: Sequence[str] = ("date",), rows_per_block: int | None = ROWS_PER_BLOCK
) -> DataFrame:
    return with_row_frames(df, lag_columns, max(LAG_ROWS), 0, STATION, order, rows_per_block)


def target_features(
    df: DataFrame, order: Sequence[str] = ("date",), rows_per_block: int | None = ROWS_PER_BLOCK
) -> DataFrame:
    return with_row_frames(df, target_columns, 0, WINDOW_ROWS, STATION, order, rows_per_block)


def window_features(
    df: DataFrame, order: Sequence[str] = ("date",), rows_per_block: int | None = ROWS_PER_BLOCK
) -> DataFrame:
    """Rolling, lag and target columns together: one shuffle and one sort for all twenty.

    ``order`` may name tie-break columns after the date; rows equal in all of them have no defined order.
    """
    return with_row_frames(
        df,
        lambda ordered: {**rolling_columns(ordered), **lag_columns(ordered), **target_columns(ordered)},
        WINDOW_ROWS - 1,
        WINDOW_ROWS,
        STATION,
        order,
        rows_per_block,
    )


def drop_nulls(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Keep rows without a null in ``columns`` (default: in any column)."""
    return df.dropna("any", subset=list(columns) if columns else None)


def drop_accounting(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row: how many rows :func:`drop_nulls` would see, keep and drop, and the dropped percentage.

    NaN counts as null, as there.
    """
    complete = [~missing(df, c) for c in (columns or df.columns)]
    kept = complete[0]
    for condition in complete[1:]:
        kept = kept & condition
    return df.agg(F.count("*").alias("rows_before"), F.count_if(kept).alias("rows_after")).select(
        "rows_before",
        "rows_after",
        (F.col("rows_before") - F.col("rows_after")).alias("rows_dropped"),
        guarded_ratio(
            (F.col("rows_before") - F.col("rows_after")) * 100.0, F.col("rows_before"), 0.0
        ).alias("percent_dropped"),
    )
