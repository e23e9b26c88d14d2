"""Column expressions: each takes columns and returns a column, all built-in and codegen-friendly."""

from .aqi import aqi_alert, aqi_description, aqi_label, aqi_level, aqi_level_by_key
from .expressions import (
    capitalize_first,
    celsius,
    finite_or_null,
    guarded_ratio,
    half_up,
    is_finite,
    is_weekend,
    missing,
    season,
    wind_direction,
    wind_speed,
)

__all__ = [
    "aqi_alert", "aqi_description", "aqi_label", "aqi_level", "aqi_level_by_key",
    "capitalize_first", "celsius", "finite_or_null", "guarded_ratio", "half_up", "is_finite",
    "is_weekend", "missing", "season", "wind_direction", "wind_speed",
]
