"""Calendar parts of a date or timestamp column."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def hour_of_day(ts: Column) -> Column:
    return F.hour(ts)


def month_of_year(ts: Column) -> Column:
    return F.month(ts)


def day_of_week(ts: Column) -> Column:
    """Monday = 0 … Sunday = 6 (Spark's `dayofweek` would start at Sunday = 1)."""
    return F.weekday(ts)


def day_of_year(ts: Column) -> Column:
    return F.dayofyear(ts)


def iso_week(ts: Column) -> Column:
    return F.weekofyear(ts)


def is_weekend(ts: Column) -> Column:
    return (F.weekday(ts) >= 5).cast("int")


def is_holiday(ts: Column, weekend: Column | None = None) -> Column:
    """1 on weekends and on 25 December.

    `weekend` lets a table that already carries a 0/1 weekend column reuse it.
    """
    weekend = is_weekend(ts) if weekend is None else weekend
    christmas = (F.month(ts) == 12) & (F.dayofmonth(ts) == 25)
    return F.coalesce((weekend == 1) | christmas, F.lit(False)).cast("int")


def format_date(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd")


def local_time(ts: Column, zone: str) -> Column:
    """Wall-clock time in `zone` of a UTC timestamp."""
    return F.from_utc_timestamp(ts, zone)


def calendar_features(ts: Column, hourly: bool = False) -> dict[str, Column]:
    """Model features of a date; pass the result to `withColumns`."""
    features = {"hour": hour_of_day(ts)} if hourly else {}
    return features | {
        "month": month_of_year(ts),
        "day_of_year": day_of_year(ts),
        "week_of_year": iso_week(ts),
        "is_weekend": is_weekend(ts),
    }
