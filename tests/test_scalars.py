import datetime as dt
import math

import pandas as pd
import pytest
from pyspark.sql import functions as F

from squall.functions import (
    any_positive,
    calendar_features,
    cut,
    flag,
    heat_index,
    hourly_flags,
    is_holiday,
    local_time,
    precipitation_intensity,
    rain_ratio,
    relative_humidity_from_dew,
    season,
    sunshine_ratio,
    to_celsius,
    to_fahrenheit,
    wind_category,
    wind_chill,
)
from squall.operators.columns import parse_time


def one(spark, column, **values):
    """Value of a column expression over one row of doubles."""
    schema = ", ".join(f"{k} double" for k in values) or "dummy double"
    row = tuple(values.values()) or (0.0,)
    return spark.createDataFrame([row], schema).select(column.alias("v")).first().v


def on_day(spark, column, day):
    df = spark.createDataFrame([(day,)], "d date")
    return df.select(column.alias("v")).first().v


@pytest.mark.parametrize(
    "month, label",
    [(1, "Winter"), (3, "Winter"), (4, "Spring"), (6, "Spring"), (7, "Summer"), (9, "Summer"),
     (10, "Fall"), (12, "Fall")],
)
def test_season_edges(spark, month, label):
    assert on_day(spark, season(F.col("d")), dt.date(2024, month, 15)) == label


@pytest.mark.parametrize(
    "speed, label",
    [(-1.0, None), (0.0, None), (0.1, "Calm"), (2.0, "Calm"), (2.1, "Light"), (5.0, "Light"),
     (8.0, "Moderate"), (11.0, "Fresh"), (11.1, "Strong"), (None, None)],
)
def test_wind_category_edges(spark, speed, label):
    assert one(spark, wind_category(F.col("w")), w=speed) == label


@pytest.mark.parametrize("right", [True, False])
@pytest.mark.parametrize("include_lowest", [True, False])
def test_cut_matches_pandas(spark, right, include_lowest):
    values, edges, labels = [-1.0, 0.0, 1.0, 2.0, 3.0, 4.0, 5.0, 6.0], [0, 2, 4, 5], ["a", "b", "c"]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [
        r[0]
        for r in df.orderBy("v")
        .select(cut(F.col("v"), edges, labels, right, include_lowest))
        .collect()
    ]
    if right or not include_lowest:
        want = pd.cut(values, edges, labels=labels, right=right, include_lowest=include_lowest)
        assert got == [None if pd.isna(w) else w for w in want]
    else:
        assert got == [None, "a", "a", "b", "b", "c", "c", None]


def test_calendar_edges(spark):
    def features(day):
        f = calendar_features(F.col("d"))
        return on_day(spark, F.struct(*[c.alias(n) for n, c in f.items()]), day).asDict()

    assert features(dt.date(2024, 12, 30)) == {
        "month": 12, "day_of_year": 365, "week_of_year": 1, "is_weekend": 0,
    }
    assert features(dt.date(2021, 1, 3)) == {
        "month": 1, "day_of_year": 3, "week_of_year": 53, "is_weekend": 1,
    }
    assert features(dt.date(2024, 2, 29))["day_of_year"] == 60


def test_holiday_is_weekend_or_christmas(spark):
    assert on_day(spark, is_holiday(F.col("d")), dt.date(2024, 12, 25)) == 1
    assert on_day(spark, is_holiday(F.col("d")), dt.date(2024, 12, 24)) == 0
    assert on_day(spark, is_holiday(F.col("d")), dt.date(2024, 11, 25)) == 0
    assert on_day(spark, is_holiday(F.col("d")), dt.date(2024, 12, 28)) == 1
    assert on_day(spark, is_holiday(F.col("d"), F.lit(1)), dt.date(2024, 11, 25)) == 1


def test_local_time_crosses_midnight(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 7, 1, 2),)], "t timestamp")
    got = df.select(local_time(F.col("t"), "America/New_York").cast("string")).first()[0]
    assert got == "2024-06-30 22:00:00"


def test_formulas(spark):
    t, v, rh, d = 5.0, 4.0, 60.0, 1.0
    k = (v * 3.6) ** 0.16
    want = 13.12 + 0.6215 * t - 11.37 * k + 0.3965 * t * k
    assert one(spark, wind_chill(F.col("t"), F.col("v")), t=t, v=v) == pytest.approx(want)
    assert one(spark, wind_chill(F.col("t"), F.col("v")), t=t, v=-1.0) is None
    want = (
        -42.379 + 2.04901523 * t + 10.14333127 * rh - 0.22475541 * t * rh - 6.83783e-3 * t**2
        - 5.481717e-2 * rh**2 + 1.22874e-3 * t**2 * rh + 8.5282e-4 * t * rh**2
        - 1.99e-6 * t**2 * rh**2
    )
    assert one(spark, heat_index(F.col("t"), F.col("h")), t=t, h=rh) == pytest.approx(want)
    want = 100 * math.exp(17.625 * d / (243.04 + d)) / math.exp(17.625 * t / (243.04 + t))
    got = one(spark, relative_humidity_from_dew(F.col("t"), F.col("d")), t=t, d=d)
    assert got == pytest.approx(want)
    assert one(spark, relative_humidity_from_dew(F.col("t"), F.col("d")), t=t, d=-243.04) is None


def test_units_round_trip(spark):
    assert one(spark, to_fahrenheit(F.col("c")), c=100.0) == 212
    assert one(spark, to_celsius(F.col("f")), f=32.0) == 0


@pytest.mark.parametrize("divide", [precipitation_intensity, sunshine_ratio, rain_ratio])
def test_ratios_guard_zero(spark, divide):
    assert one(spark, divide(F.col("a"), F.col("b")), a=1.0, b=0.0) is None
    assert one(spark, divide(F.col("a"), F.col("b")), a=0.0, b=0.0) is None
    assert one(spark, divide(F.col("a"), F.col("b")), a=1.0, b=4.0) == 0.25


def test_flags_of_unknown_values_are_zero(spark):
    assert one(spark, flag(F.col("a") > 0), a=None) == 0
    flags = hourly_flags(F.col("t"), F.col("p"), F.col("s"))
    assert one(spark, flags["is_freezing"], t=0.0, p=None, s=None) == 1
    assert one(spark, flags["is_raining"], t=0.0, p=None, s=None) == 0
    assert one(spark, any_positive(F.col("a"), F.col("b")), a=None, b=0.1) == 1
    assert one(spark, any_positive(F.col("a"), F.col("b")), a=None, b=0.0) == 0


def test_parse_time(spark):
    df = spark.createDataFrame([("2024-02-29",), ("x",)], "s string")
    got = df.select(parse_time(F.col("s"), "yyyy-MM-dd", tolerant=True).cast("string")).collect()
    assert [r[0] for r in got] == ["2024-02-29 00:00:00", None]
    with pytest.raises(Exception, match="CANNOT_PARSE_TIMESTAMP"):
        df.select(parse_time(F.col("s"), "yyyy-MM-dd")).collect()
