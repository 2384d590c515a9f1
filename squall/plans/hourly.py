"""From raw hourly observations to engineered features."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from squall.functions.binning import season, wind_category
from squall.functions.calendar import (
    day_of_week,
    hour_of_day,
    is_holiday,
    is_weekend,
    month_of_year,
)
from squall.functions.comfort import (
    dew_point_depression,
    heat_index,
    relative_humidity_from_dew,
    to_celsius,
    wind_chill,
)
from squall.functions.rates import any_positive, hourly_flags
from squall.operators.blocks import DAY
from squall.operators.columns import (
    as_category,
    drop_all_null_columns,
    nan_to_null,
    numeric_columns,
)
from squall.operators.encode import factorize
from squall.operators.missing import ZERO_FILLED, impute_by_rule
from squall.operators.rolling import rolling
from squall.operators.scaling import minmax_fit, minmax_scale
from squall.storage import materialise

TS = "datetime"
BLOCK_WIDTH = 360 * DAY  # at most 8,640 rows of one station on an hourly axis
ROLLING_ROWS = 24
MEASURED = (
    "temperature_2m", "relative_humidity_2m", "dew_point_2m", "precipitation", "snowfall", "wind_speed_10m",
)


def preprocess(
    df: DataFrame,
    keys: Sequence[str] = (),
    *,
    ties: Sequence[str] = (),
    scale: bool = True,
    width: int | None = BLOCK_WIDTH,
) -> tuple[DataFrame, DataFrame]:
    """Impute by rule, add precipitation flag, season, hour and weekend, scale to [0, 1].

    Returns the rows and the scaler table. `weather_code` is a category and is not scaled. Columns that are
    empty are dropped, after scaling also observed ones that are constant in every key. `ties` complete the
    order where times repeat; like keys they are left as they are.
    """
    raw = nan_to_null(df).withColumn(TS, F.to_timestamp(TS))
    filled = impute_by_rule(
        raw, numeric_columns(raw, exclude=[*keys, *ties]), ts=TS, keys=keys, ties=ties, width=width
    )
    added = {
        "is_precipitation": any_positive(*map(F.col, ZERO_FILLED)),
        "season": season(F.col(TS)),
        "hour": hour_of_day(F.col(TS)),
        "is_weekend": is_weekend(F.col(TS)),
    }
    rows = as_category(materialise(filled.withColumns(added), "hourly-filled"), ["weather_code"])
    rows = drop_all_null_columns(rows)
    cols = numeric_columns(rows, exclude=[*keys, *ties])
    scaler = materialise(minmax_fit(rows, cols, keys), "hourly-scaler")
    if scale:
        flat = constant_columns(scaler, [c for c in cols if c in df.columns])
        rows = minmax_scale(rows, cols, keys, scaler).drop(*flat)
    return as_category(rows, ["is_weekend", "is_precipitation"]), scaler


def constant_columns(scaler: DataFrame, cols: Sequence[str]) -> list[str]:
    """Those of `cols` that are constant in every key, hence empty once scaled; the scaler table tells."""
    spread = {r["column"] for r in scaler.filter("max > min").select("column").distinct().collect()}
    return [c for c in cols if c not in spread]


def engineer(
    df: DataFrame,
    keys: Sequence[str] = (),
    *,
    ties: Sequence[str] = (),
    fahrenheit: bool = False,
    width: int | None = BLOCK_WIDTH,
) -> DataFrame:
    """Calendar parts, season code, 24-row rolling figures, comfort formulas and wind category.

    The formulas take °C; with `fahrenheit=True` the temperature columns are converted for them. A measured
    column that preprocessing dropped counts as null.
    """
    lacking = [c for c in MEASURED if c not in df.columns]
    df = df.withColumns({c: F.lit(None).cast("double") for c in lacking})

    def celsius(name: str):
        return to_celsius(F.col(name)) if fahrenheit else F.col(name)

    temperature, dew = celsius("temperature_2m"), celsius("dew_point_2m")
    rain, wind = F.col("precipitation"), F.col("wind_speed_10m")
    ts = F.col(TS)
    rows = factorize(df, "season", ts=TS, keys=keys).withColumns(
        {
            "month": month_of_year(ts),
            "day_of_week": day_of_week(ts),
            "is_holiday": is_holiday(ts, F.col("is_weekend")),
        }
    )
    rows = rolling(
        rows,
        {
            "temp_rolling_mean_24h": ("temperature_2m", "avg"),
            "precip_rolling_sum_24h": ("precipitation", "sum"),
        },
        rows=ROLLING_ROWS,
        ts=TS,
        keys=keys,
        ties=ties,
        width=width,
    )
    return rows.withColumns(
        hourly_flags(temperature, rain, F.col("snowfall"))
        | {
            "wind_chill": wind_chill(temperature, wind),
            "heat_index": heat_index(temperature, F.col("relative_humidity_2m")),
            "dew_point_depression": dew_point_depression(temperature, dew),
            "calculated_relative_humidity": relative_humidity_from_dew(temperature, dew),
            "wind_category": wind_category(wind),
        }
    ).drop(*lacking)


def hourly_features(
    df: DataFrame,
    keys: Sequence[str] = (),
    *,
    ties: Sequence[str] = (),
    scale: str = "after",
    fahrenheit: bool = False,
    **options,
) -> tuple[DataFrame, DataFrame]:
    """Raw observations to engineered rows, and the scaler table (see the daily counterpart).

    In both orders observed columns that scaling empties, being constant in every key, are left out.
    """
    if scale not in ("before", "after", "none"):
        raise ValueError(f"unknown scale order: {scale}")
    rows, scaler = preprocess(df, keys, ties=ties, scale=scale == "before", **options)
    rows = engineer(rows, keys, ties=ties, fahrenheit=fahrenheit, **options)
    if scale == "after":
        measured = [c for c in numeric_columns(rows, exclude=[*keys, *ties]) if c in df.columns]
        rows = minmax_scale(rows, measured, keys, scaler).drop(*constant_columns(scaler, measured))
    return rows, scaler
