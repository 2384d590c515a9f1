"""From raw daily observations to engineered features."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from squall.functions.binning import season
from squall.functions.calendar import is_weekend
from squall.functions.rates import flag, precipitation_intensity, rain_ratio, sunshine_ratio
from squall.operators.blocks import DAY
from squall.operators.columns import as_category, drop_columns, nan_to_null, numeric_columns
from squall.operators.encode import factorize
from squall.operators.flags import quantile_flags
from squall.operators.missing import ffill
from squall.operators.scaling import clip_and_scale, minmax_scale
from squall.storage import materialise

TS = "date"
BLOCK_WIDTH = 3_600 * DAY  # at most 3,600 rows of one station on a daily axis

# Columns that are filled forward, dropped before and dropped after scaling.
FORWARD_FILLED = (
    "weather_code", "temperature_2m_max", "temperature_2m_min", "apparent_temperature_max",
    "apparent_temperature_min", "sunshine_duration", "precipitation_sum", "rain_sum",
    "snowfall_sum", "wind_speed_10m_max", "wind_gusts_10m_max", "wind_direction_10m_dominant",
    "shortwave_radiation_sum", "et0_fao_evapotranspiration",
)
DROPPED_RAW = (
    "uv_index_max", "uv_index_clear_sky_max", "precipitation_probability_max", "sunrise", "sunset",
)
DROPPED_ENGINEERED = (
    "wind_speed_10m_max", "wind_gusts_10m_max", "wind_direction_10m_dominant",
    "shortwave_radiation_sum", "et0_fao_evapotranspiration",
)


def preprocess(
    df: DataFrame,
    keys: Sequence[str] = (),
    *,
    forward_filled: Sequence[str] = FORWARD_FILLED,
    dropped: Sequence[str] = DROPPED_RAW,
    ties: Sequence[str] = (),
    scale: bool = True,
    width: int | None = BLOCK_WIDTH,
) -> tuple[DataFrame, DataFrame]:
    """Fill forward, clip, add season and weekend, scale to [0, 1].

    Returns the rows and the scaler table. The filled rows are written once, because the statistics
    and the rows themselves both read them. `ties` complete the order where times repeat; like keys they
    are left as they are.
    """
    kept = drop_columns(nan_to_null(df), dropped).withColumn(TS, F.to_date(TS))
    filled = ffill(kept, forward_filled, ts=TS, keys=keys, ties=ties, width=width)
    filled = materialise(
        filled.withColumns({"season": season(F.col(TS)), "is_weekend": is_weekend(F.col(TS))}),
        "daily-filled",
    )
    cols = numeric_columns(filled, exclude=[*keys, *ties])
    rows, scaler = clip_and_scale(filled, cols, keys, unclipped=["is_weekend"], scale=scale)
    return as_category(rows, ["weather_code", "is_weekend"]), scaler


def engineer(
    df: DataFrame, keys: Sequence[str] = (), *, dropped: Sequence[str] = DROPPED_ENGINEERED
) -> DataFrame:
    """Season code, temperature range, extreme-day flags, precipitation and sunshine ratios."""
    coded = factorize(drop_columns(df, dropped), "season", ts=TS, keys=keys)
    spread = F.col("temperature_2m_max") - F.col("temperature_2m_min")
    rain = F.col("precipitation_sum")
    rows = coded.withColumns(
        {
            "temperature_range": spread,
            "is_rainy_day": flag(rain > 0),
            "precipitation_intensity": precipitation_intensity(rain, F.col("precipitation_hours")),
            "diurnal_temp_range": spread,
            "sunshine_ratio": sunshine_ratio(
                F.col("sunshine_duration"), F.col("daylight_duration")
            ),
            "rain_ratio": rain_ratio(F.col("rain_sum"), rain),
        }
    )
    return quantile_flags(rows, keys=keys)


def daily_features(
    df: DataFrame, keys: Sequence[str] = (), *, ties: Sequence[str] = (), scale: str = "after", **options
) -> tuple[DataFrame, DataFrame]:
    """Raw observations to engineered rows, and the scaler table.

    `scale="before"` computes the features on scaled values; `"after"` computes them in the units
    of the observations and scales the observations afterwards; `"none"` does not scale.
    """
    if scale not in ("before", "after", "none"):
        raise ValueError(f"unknown scale order: {scale}")
    rows, scaler = preprocess(df, keys, ties=ties, scale=scale == "before", **options)
    rows = engineer(rows, keys)
    if scale == "after":
        measured = [c for c in numeric_columns(rows, exclude=[*keys, *ties]) if c in df.columns]
        rows = minmax_scale(rows, measured, keys, scaler)
    return rows, scaler
