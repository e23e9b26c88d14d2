"""Row-wise expressions used by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_INFINITIES = [float("inf"), float("-inf")]


def celsius(fahrenheit: Column) -> Column:
    return (fahrenheit - 32.0) * 5.0 / 9.0


def guarded_ratio(numerator: Column, denominator: Column, otherwise: float | None = None) -> Column:
    """Quotient where the denominator is positive; ``otherwise`` elsewhere, also for a null denominator."""
    return F.when(denominator > 0, numerator / denominator).otherwise(F.lit(otherwise).cast("double"))


def is_weekend(day_of_week: Column) -> Column:
    """1 for Saturday and Sunday (Sunday is day 1), else 0."""
    return F.when(day_of_week.isin(1, 7), 1).otherwise(0)


def season(month: Column) -> Column:
    """Meteorological season of the northern hemisphere; an unknown month counts as fall."""
    return (
        F.when(month.isin(12, 1, 2), "winter")
        .when(month.between(3, 5), "spring")
        .when(month.between(6, 8), "summer")
        .otherwise("fall")
    )


def wind_speed(u: Column, v: Column) -> Column:
    return F.sqrt(u * u + v * v)


def wind_direction(u: Column, v: Column) -> Column:
    """Angle in degrees, counter-clockwise from east, in (-180, 180]."""
    return F.degrees(F.atan2(v, u))


def is_finite(value: Column) -> Column:
    """True for ordinary numbers; false for null, NaN and the infinities."""
    return value.isNotNull() & ~F.isnan(value) & ~value.isin(_INFINITIES)


def finite_or_null(value: Column) -> Column:
    return F.when(is_finite(value), value)


def half_up(value: Column, digits: int) -> Column:
    """Round half away from zero on the decimal form, so 1.005 gives 1.01; on the double beyond decimals."""
    exact = F.round(value.try_cast("decimal(38,12)"), digits).cast("double")
    return F.coalesce(exact, F.round(value.cast("double"), digits))


def missing(df: DataFrame, column: str) -> Column:
    """True for null and, in floating-point columns, NaN."""
    value = F.col(column)
    real = dict(df.dtypes)[column] in ("double", "float")
    return value.isNull() | F.isnan(value) if real else value.isNull()


def capitalize_first(text: Column) -> Column:
    """First letter to upper case, the rest as it is."""
    return F.concat(F.upper(F.substring(text, 1, 1)), F.substr(text, F.lit(2)))
