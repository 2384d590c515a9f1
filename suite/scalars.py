"""Scalar functions on readings (one row per event) and on daily rows."""

from pyspark.sql import functions as F

from squall.functions import binning, calendar, comfort, rates
from squall.operators import columns
from squall.operators.encode import factorize
from squall.operators.flags import quantile_flags
from suite.registry import ORACLES, case, day, num, stamp
from suite.views import (
    DAILY_CTE,
    READINGS_CTE,
    STATION,
    daily,
    readings,
    table,
)



def _reading_case(name: str, sql: str, **added):
    """Query that adds columns to the readings, and its SQL select list."""
    text = f"with {READINGS_CTE} select event_id, {sql} from readings"

    @case(name, text)
    def query(spark, sf_dir):
        rows = readings(spark, sf_dir)
        return rows.select("event_id", *[fn().alias(alias) for alias, fn in added.items()])

    return query


_reading_case(
    "season",
    "case when month(datetime) <= 3 then 'Winter' when month(datetime) <= 6 then 'Spring' "
    "when month(datetime) <= 9 then 'Summer' else 'Fall' end as season",
    season=lambda: binning.season(F.col("datetime")),
)
_reading_case(
    "is_weekend",
    "cast(isodow(datetime) >= 6 as int) as is_weekend",
    is_weekend=lambda: calendar.is_weekend(F.col("datetime")),
)
_reading_case(
    "hour_of_day",
    "cast(hour(datetime) as int) as hour",
    hour=lambda: calendar.hour_of_day(F.col("datetime")),
)
_reading_case(
    "day_of_week",
    "cast(isodow(datetime) - 1 as int) as day_of_week",
    day_of_week=lambda: calendar.day_of_week(F.col("datetime")),
)
_reading_case(
    "wind_category",
    "case when wind_speed_10m <= 0 then null when wind_speed_10m <= 2 then 'Calm' "
    "when wind_speed_10m <= 5 then 'Light' when wind_speed_10m <= 8 then 'Moderate' "
    "when wind_speed_10m <= 11 then 'Fresh' else 'Strong' end as wind_category",
    wind_category=lambda: binning.wind_category(F.col("wind_speed_10m")),
)
_reading_case(
    "weather_flags_hourly",
    "cast(coalesce(dew_point_2m <= 0, false) as int) as is_freezing, "
    "cast(coalesce(rain > 0, false) as int) as is_raining, "
    "cast(coalesce(snowfall > 0, false) as int) as is_snowing",
    **{
        name: (lambda n=name: rates.hourly_flags(
            F.col("dew_point_2m"), F.col("rain"), F.col("snowfall"))[n])
        for name in ("is_freezing", "is_raining", "is_snowing")
    },
)
_reading_case(
    "wind_chill",
    num(
        "13.12e0 + 0.6215e0 * temperature_2m - 11.37e0 * pow(wind_speed_10m * 3.6e0, 0.16e0) "
        "+ 0.3965e0 * temperature_2m * pow(wind_speed_10m * 3.6e0, 0.16e0)",
        "wind_chill",
    ),
    wind_chill=lambda: comfort.wind_chill(F.col("temperature_2m"), F.col("wind_speed_10m")),
)
_reading_case(
    "heat_index",
    num(
        "-42.379e0 + 2.04901523e0 * t + 10.14333127e0 * h - 0.22475541e0 * t * h "
        "- 0.00683783e0 * t * t - 0.05481717e0 * h * h + 0.00122874e0 * t * t * h "
        "+ 0.00085282e0 * t * h * h - 0.00000199e0 * t * t * h * h".replace(
            " t", " temperature_2m"
        ).replace(" h", " relative_humidity_2m"),
        "heat_index",
    ),
    heat_index=lambda: comfort.heat_index(F.col("temperature_2m"), F.col("relative_humidity_2m")),
)
_reading_case(
    "dew_point_depression",
    num("temperature_2m - dew_point_2m", "dew_point_depression"),
    dew_point_depression=lambda: comfort.dew_point_depression(
        F.col("temperature_2m"), F.col("dew_point_2m")
    ),
)
_reading_case(
    "relative_humidity_from_dew",
    num(
        "100 * exp(17.625e0 * dew_point_2m / (243.04e0 + dew_point_2m)) "
        "/ exp(17.625e0 * temperature_2m / (243.04e0 + temperature_2m))",
        "calculated_relative_humidity",
    ),
    calculated_relative_humidity=lambda: comfort.relative_humidity_from_dew(
        F.col("temperature_2m"), F.col("dew_point_2m")
    ),
)
_reading_case(
    "is_precipitation",
    "cast(coalesce(precipitation > 0, false) or coalesce(rain > 0, false) or "
    "coalesce(showers > 0, false) or coalesce(snowfall > 0, false) as int) as is_precipitation",
    is_precipitation=lambda: rates.any_positive(
        *map(F.col, ("precipitation", "rain", "showers", "snowfall"))
    ),
)
_reading_case(
    "convert_unit",
    num("temperature_2m * 9 / 5 + 32", "fahrenheit")
    + ", "
    + num("(temperature_2m * 9 / 5 + 32 - 32) * 5 / 9", "celsius"),
    fahrenheit=lambda: comfort.to_fahrenheit(F.col("temperature_2m")),
    celsius=lambda: comfort.to_celsius(comfort.to_fahrenheit(F.col("temperature_2m"))),
)
_reading_case(
    "local_time",
    stamp("datetime at time zone 'UTC' at time zone 'America/New_York'", "local_datetime")
    + ", "
    + day("datetime at time zone 'UTC' at time zone 'America/New_York'", "local_date"),
    local_datetime=lambda: calendar.local_time(F.col("datetime"), "America/New_York"),
    local_date=lambda: F.to_date(calendar.local_time(F.col("datetime"), "America/New_York")),
)


def _order_case(name: str, sql: str, **added):
    """The same over orders, whose dates span several years."""

    @case(name, f"select o_orderkey, {sql} from orders")
    def query(spark, sf_dir):
        rows = table(spark, sf_dir, "orders")
        return rows.select("o_orderkey", *[fn().alias(alias) for alias, fn in added.items()])

    return query


_order_case(
    "month_of_year", "cast(month(o_orderdate) as int) as month",
    month=lambda: calendar.month_of_year(F.col("o_orderdate")),
)
_order_case(
    "day_of_year", "cast(dayofyear(o_orderdate) as int) as day_of_year",
    day_of_year=lambda: calendar.day_of_year(F.col("o_orderdate")),
)
_order_case(
    "iso_week", "cast(weekofyear(o_orderdate) as int) as week_of_year",
    week_of_year=lambda: calendar.iso_week(F.col("o_orderdate")),
)
_order_case(
    "is_holiday",
    "cast(isodow(o_orderdate) >= 6 or (month(o_orderdate) = 12 and day(o_orderdate) = 25) as int) "
    "as is_holiday",
    is_holiday=lambda: calendar.is_holiday(F.col("o_orderdate")),
)
_order_case(
    "format_date", day("o_orderdate", "day"), day=lambda: calendar.format_date(F.col("o_orderdate")),
)
_order_case(
    "parse_time",
    stamp("o_orderdate", "datetime") + ", " + day("o_orderdate", "date"),
    datetime=lambda: columns.parse_time(F.date_format(F.col("o_orderdate"), "yyyy-MM-dd"), "yyyy-MM-dd"),
    date=lambda: F.to_date(columns.parse_time(F.date_format(F.col("o_orderdate"), "dd/MM/yyyy"), "dd/MM/yyyy")),
)
CALENDAR_SQL = (
    "cast(month({0}) as int) as month, cast(dayofyear({0}) as int) as day_of_year, "
    "cast(weekofyear({0}) as int) as week_of_year, cast(isodow({0}) >= 6 as int) as is_weekend"
)
_order_case(
    "calendar_features",
    CALENDAR_SQL.format("o_orderdate"),
    **{
        name: (lambda n=name: calendar.calendar_features(F.col("o_orderdate"))[n])
        for name in ("month", "day_of_year", "week_of_year", "is_weekend")
    },
)


def _daily_case(name: str, sql: str, **added):
    @case(name, f"with {DAILY_CTE} select station, {day('date', 'date')}, {sql} from daily")
    def query(spark, sf_dir):
        rows = daily(spark, sf_dir)
        return rows.select(*STATION, "date", *[fn().alias(alias) for alias, fn in added.items()])

    return query


def _spread():
    return F.col("temperature_2m_max") - F.col("temperature_2m_min")


_daily_case(
    "temperature_range",
    num("temperature_2m_max - temperature_2m_min", "temperature_range") + ", "
    + num("temperature_2m_max - temperature_2m_min", "diurnal_temp_range"),
    temperature_range=_spread,
    diurnal_temp_range=_spread,
)
_daily_case(
    "precipitation_intensity",
    num("precipitation_sum / nullif(precipitation_hours, 0)", "precipitation_intensity"),
    precipitation_intensity=lambda: rates.precipitation_intensity(
        F.col("precipitation_sum"), F.col("precipitation_hours")
    ),
)
_daily_case(
    "sunshine_ratio",
    num("sunshine_duration / nullif(daylight_duration, 0)", "sunshine_ratio"),
    sunshine_ratio=lambda: rates.sunshine_ratio(
        F.col("sunshine_duration"), F.col("daylight_duration")
    ),
)
_daily_case(
    "rain_ratio",
    num("rain_sum / nullif(precipitation_sum, 0)", "rain_ratio"),
    rain_ratio=lambda: rates.rain_ratio(F.col("rain_sum"), F.col("precipitation_sum")),
)
_daily_case(
    "is_rainy_day",
    "cast(coalesce(precipitation_sum > 0, false) as int) as is_rainy_day",
    is_rainy_day=lambda: rates.flag(F.col("precipitation_sum") > 0),
)


@case(
    "quantile_flags",
    f"""with {DAILY_CTE},
    q as (select station, quantile_cont(temperature_2m_max, 0.9) as hot,
                 quantile_cont(temperature_2m_min, 0.1) as cold,
                 quantile_cont(precipitation_sum, 0.95) as wet from daily group by 1)
    select station, {day('date', 'date')},
           cast(coalesce(temperature_2m_max > hot, false) as int) as is_hot_day,
           cast(coalesce(temperature_2m_min < cold, false) as int) as is_cold_day,
           cast(coalesce(precipitation_sum > wet, false) as int) as is_heavy_precipitation
    from daily join q using (station)""",
)
def _quantile_flags(spark, sf_dir):
    return _flagged(spark, sf_dir)


@case("quantile_flags_large", ORACLES["quantile_flags"])
def _quantile_flags_large(spark, sf_dir):
    """As for groups too large for one task, whatever their size here."""
    return _flagged(spark, sf_dir, max_values_in_task=0)


def _flagged(spark, sf_dir, **options):
    flagged = quantile_flags(daily(spark, sf_dir), keys=STATION, **options)
    return flagged.select(
        *STATION, "date", "is_hot_day", "is_cold_day", "is_heavy_precipitation"
    )


@case(
    "factorize",
    f"""with {READINGS_CTE},
    rows as (select event_id, station, datetime,
                    case when showers > 0 or wind_speed_10m <= 0 then null
                         when wind_speed_10m <= 2 then 'Calm'
                         when wind_speed_10m <= 5 then 'Light' when wind_speed_10m <= 8 then 'Moderate'
                         when wind_speed_10m <= 11 then 'Fresh' else 'Strong' end as label
             from readings),
    firsts as (select station, label, min(datetime) as seen from rows
               where label is not null group by 1, 2),
    codes as (select station, label,
                     cast(row_number() over (partition by station order by seen, label) - 1 as int) as c
              from firsts)
    select event_id, coalesce(c, -1) as code
    from rows left join codes using (station, label)""",
)
def _factorize(spark, sf_dir):
    label = F.when(
        ~(F.col("showers") > 0), binning.wind_category(F.col("wind_speed_10m"))
    )
    rows = readings(spark, sf_dir).withColumn("label", label)
    return factorize(rows, "label", ts="datetime", keys=STATION, name="code").select(
        "event_id", "code"
    )
