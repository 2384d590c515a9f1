"""Scalar functions: Column in, Column out, built-in expressions only."""

from squall.functions.binning import cut, season, wind_category
from squall.functions.calendar import (
    calendar_features,
    day_of_week,
    day_of_year,
    format_date,
    hour_of_day,
    is_holiday,
    is_weekend,
    iso_week,
    local_time,
    month_of_year,
)
from squall.functions.comfort import (
    dew_point_depression,
    heat_index,
    relative_humidity_from_dew,
    to_celsius,
    to_fahrenheit,
    wind_chill,
)
from squall.functions.rates import (
    any_positive,
    flag,
    hourly_flags,
    precipitation_intensity,
    rain_ratio,
    sunshine_ratio,
)

__all__ = [
    "any_positive", "calendar_features", "cut", "day_of_week", "day_of_year",
    "dew_point_depression", "flag", "format_date", "heat_index", "hour_of_day", "hourly_flags",
    "is_holiday", "is_weekend", "iso_week", "local_time", "month_of_year",
    "precipitation_intensity", "rain_ratio", "relative_humidity_from_dew", "season",
    "sunshine_ratio", "to_celsius", "to_fahrenheit", "wind_category", "wind_chill",
]
