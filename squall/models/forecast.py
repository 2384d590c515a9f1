"""Forecast grids and their predictions in original units."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from squall.functions.calendar import calendar_features
from squall.models.predictors import Predictor, prediction
from squall.operators.scaling import minmax_inverse

DAYS = 7


def daily_calendar(stations: DataFrame, as_of: str, days: int = DAYS) -> DataFrame:
    """`days` dates from `as_of` for every station, with their features."""
    start = F.lit(as_of).cast("date")
    dates = F.sequence(start, F.date_add(start, days - 1))
    return stations.select("*", F.explode(dates).alias("date")).withColumns(
        calendar_features(F.col("date"))
    )


def hourly_calendar(stations: DataFrame, dates: Sequence[str]) -> DataFrame:
    """24 hours of each of the dates for every station, with their features."""
    days = F.array(*[F.lit(d).cast("date") for d in dates])
    grid = stations.select("*", F.explode(days).alias("date"))
    features = calendar_features(F.col("date"))
    hours = F.explode(F.sequence(F.lit(0), F.lit(23))).alias("hour")
    return grid.select("*", hours).withColumns(features)


def forecast(
    model: Predictor,
    calendar: DataFrame,
    scaler: DataFrame | None = None,
    keys: Sequence[str] = (),
) -> DataFrame:
    """Calendar rows with one column per target; `scaler` takes scaled targets back to units."""
    scored = model.score(calendar).withColumnsRenamed({prediction(t): t for t in model.targets})
    rows = scored.select(*calendar.columns, *model.targets)
    return rows if scaler is None else minmax_inverse(rows, scaler, list(model.targets), keys)


def forecast_daily(
    model: Predictor,
    stations: DataFrame,
    as_of: str,
    scaler: DataFrame | None = None,
    keys: Sequence[str] = (),
    days: int = DAYS,
) -> DataFrame:
    return forecast(model, daily_calendar(stations, as_of, days), scaler, keys)


def forecast_hourly(
    model: Predictor,
    stations: DataFrame,
    dates: Sequence[str],
    scaler: DataFrame | None = None,
    keys: Sequence[str] = (),
) -> DataFrame:
    return forecast(model, hourly_calendar(stations, dates), scaler, keys)


def predict_single_date(model: Predictor, stations: DataFrame, date: str) -> DataFrame:
    return forecast_daily(model, stations, date, days=1)


def forecast_digest(
    forecast: DataFrame, date: str, value: str, keys: Sequence[str] = (), digits: int = 2
) -> DataFrame:
    """The forecast of each key as a fixed-width text table: a header, then one line per day.

    At most a forecast horizon of rows per key comes together.
    """
    width = max(len(value), 10)
    number = F.lpad(F.format_string(f"%.{digits}f", F.col(value)), width, " ")
    line = F.concat(F.date_format(date, "yyyy-MM-dd"), F.lit("  "), number)
    lines = F.sort_array(F.collect_list(F.struct(F.col(date).alias("d"), line.alias("line"))))
    header = F.lit(f"{date:>10}  {value:>{width}}\n")
    return forecast.groupBy(*keys).agg(
        F.concat(header, F.array_join(lines["line"], "\n")).alias("digest")
    )
