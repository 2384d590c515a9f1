"""0/1 flags and guarded ratios."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def flag(predicate: Column) -> Column:
    """Predicate as 0/1; an unknown predicate (null operand) counts as 0."""
    return F.coalesce(predicate, F.lit(False)).cast("int")


def any_positive(*cols: Column) -> Column:
    """1 if any of the columns is above zero, e.g. any kind of precipitation."""
    hit = F.lit(False)
    for col in cols:
        hit = hit | F.coalesce(col > 0, F.lit(False))
    return hit.cast("int")


def hourly_flags(temperature: Column, precipitation: Column, snowfall: Column) -> dict[str, Column]:
    return {
        "is_freezing": flag(temperature <= 0),
        "is_raining": flag(precipitation > 0),
        "is_snowing": flag(snowfall > 0),
    }


def precipitation_intensity(total: Column, hours: Column) -> Column:
    """Amount per hour of precipitation; null where there were no such hours."""
    return F.try_divide(total, hours)


def sunshine_ratio(sunshine: Column, daylight: Column) -> Column:
    """Share of daylight with sun; null (not infinity) for a day without daylight."""
    return F.try_divide(sunshine, daylight)


def rain_ratio(rain: Column, precipitation: Column) -> Column:
    return F.try_divide(rain, precipitation)
