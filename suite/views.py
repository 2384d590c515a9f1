"""Weather-shaped views over the driver's tables.

Every view is one SQL text that runs unchanged in Spark and in DuckDB. `readings` keeps one row per
event, `hourly` one per event type and hour, `daily` one per order priority and day.
"""

from pyspark.sql import DataFrame, SparkSession

from squall.operators.axis import regular_grid
from squall.storage import materialise

# A reading below 2 is under the detection limit: no value.
READINGS = """
select event_type as station, event_id, user_id, cast(ts as timestamp) as datetime,
       case when value >= 2 then value end as temperature_2m,
       value / 2 - 20 as dew_point_2m,
       cast(30 + user_id % 50 as double) as relative_humidity_2m,
       case when value > 100 then value - 100 else 0 end as precipitation,
       case when value > 150 then value - 150 end as rain,
       case when value > 200 then 1e0 else 0e0 end as showers,
       case when value < 5 then 5 - value else 0 end as snowfall,
       value / 10 as wind_speed_10m,
       cast(user_id % 4 as double) as weather_code
from {events}
"""

HOURLY = """
select event_type as station, cast(date_trunc('hour', ts) as timestamp) as datetime,
       cast(sum(cast(value as decimal(18,2))) as double) / count(*) as temperature_2m,
       cast(30 + sum(user_id) % 50 as double) as relative_humidity_2m,
       min(value) / 2 as dew_point_2m,
       cast(sum(cast(value as decimal(18,2))) as double) / count(*) - max(value) / 40
         as apparent_temperature,
       cast(sum(case when value > 100 then cast(value as decimal(18,2)) else 0 end) as double)
         as precipitation,
       cast(sum(case when value > 150 then cast(value as decimal(18,2)) else 0 end) as double)
         as rain,
       cast(count(case when value > 200 then 1 end) as double) as showers,
       cast(count(case when value < 1 then 1 end) as double) as snowfall,
       cast(count(*) % 5 as double) as weather_code,
       cast(990 + sum(user_id) % 40 as double) as surface_pressure,
       cast(sum(user_id) % 101 as double) as cloud_cover,
       max(value) / 10 as wind_speed_10m,
       cast(null as double) as visibility
from {events} group by 1, 2
"""
HOURLY_COLUMNS = (
    "temperature_2m", "relative_humidity_2m", "dew_point_2m", "apparent_temperature",
    "precipitation", "rain", "showers", "snowfall", "weather_code", "surface_pressure",
    "cloud_cover", "wind_speed_10m", "visibility",
)

DAILY = """
select o_orderpriority as station, cast(o_orderdate as date) as date,
       cast(count(*) % 4 as double) as weather_code,
       max(o_totalprice) / 5000 as temperature_2m_max,
       min(o_totalprice) / 5000 as temperature_2m_min,
       max(o_totalprice) / 5000 - cast(sum(o_custkey) % 7 as double) as apparent_temperature_max,
       min(o_totalprice) / 5000 - cast(sum(o_custkey) % 5 as double) as apparent_temperature_min,
       cast(min(o_custkey) % 12 as double) as sunrise,
       cast(12 + max(o_custkey) % 12 as double) as sunset,
       cast(count(*) as double) as daylight_duration,
       cast(count(case when o_orderstatus = 'F' then 1 end) as double) as sunshine_duration,
       cast(sum(o_custkey) % 11 as double) as uv_index_max,
       cast(sum(o_custkey) % 12 as double) as uv_index_clear_sky_max,
       cast(sum(case when o_orderstatus = 'P' then cast(o_totalprice as decimal(18,2)) else 0 end)
         as double) / 10000 as precipitation_sum,
       cast(sum(case when o_orderstatus = 'P' and o_custkey % 2 = 0
         then cast(o_totalprice as decimal(18,2)) else 0 end) as double) / 10000 as rain_sum,
       cast(count(case when o_totalprice > 300000 then 1 end) as double) as showers_sum,
       cast(count(case when o_totalprice < 50000 then 1 end) as double) as snowfall_sum,
       cast(count(case when o_orderstatus = 'P' then 1 end) as double) as precipitation_hours,
       cast(sum(o_custkey) % 100 as double) as precipitation_probability_max,
       cast(sum(o_custkey) % 60 as double) as wind_speed_10m_max,
       cast(sum(o_custkey) % 60 + count(*) as double) as wind_gusts_10m_max,
       cast(sum(o_orderkey) % 360 as double) as wind_direction_10m_dominant,
       cast(sum(cast(o_totalprice as decimal(18,2))) as double) / count(*) / 1000
         as shortwave_radiation_sum,
       cast(count(*) as double) / 4 as et0_fao_evapotranspiration
from {orders} group by 1, 2
"""
DAILY_COLUMNS = (
    "weather_code", "temperature_2m_max", "temperature_2m_min", "apparent_temperature_max",
    "apparent_temperature_min", "sunrise", "sunset", "daylight_duration", "sunshine_duration",
    "uv_index_max", "uv_index_clear_sky_max", "precipitation_sum", "rain_sum", "showers_sum",
    "snowfall_sum", "precipitation_hours", "precipitation_probability_max", "wind_speed_10m_max",
    "wind_gusts_10m_max", "wind_direction_10m_dominant", "shortwave_radiation_sum",
    "et0_fao_evapotranspiration",
)

STATION = ["station"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _view(spark: SparkSession, sf_dir: str, text: str, source: str) -> DataFrame:
    return spark.sql(text, **{source: table(spark, sf_dir, source)})


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, READINGS, "events")


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, HOURLY, "events")


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, DAILY, "orders")


def hourly_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every hour of every station; hours without events are nulls.

    The observations are stored first: span, stations and rows of the grid all read them.
    """
    stored = materialise(hourly(spark, sf_dir), "hourly")
    return regular_grid(stored, "datetime", "1 hour", STATION)


def daily_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every day of every station; days without orders are nulls."""
    return regular_grid(materialise(daily(spark, sf_dir), "daily"), "date", "1 day", STATION)


def _grid_sql(view: str, ts: str, step: str) -> str:
    return f"""
    {view}_grid as (
      select a.station, a.{ts}, v.* exclude (station, {ts})
      from (select station, cast(unnest(generate_series(lo, hi, interval {step})) as timestamp) as {ts}
            from (select distinct station from {view}),
                 (select min({ts}) as lo, max({ts}) as hi from {view})) a
      left join {view} v on v.station = a.station and v.{ts} = a.{ts})
    """


READINGS_CTE = f"readings as ({READINGS.format(events='events')})"
HOURLY_CTE = f"hourly as ({HOURLY.format(events='events')})"
DAILY_CTE = f"daily as ({DAILY.format(orders='orders')})"
HOURLY_GRID_CTE = f"{HOURLY_CTE}, {_grid_sql('hourly', 'datetime', '1 hour')}"
DAILY_GRID_CTE = f"{DAILY_CTE}, {_grid_sql('daily', 'date', '1 day')}"
