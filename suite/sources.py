"""Reading and writing: every query writes real files to scratch space and reads them back."""

from pyspark.sql import functions as F

from squall.sources.responses import ingest_daily, ingest_hourly, length_violations, read_responses
from squall.sources.schemas import DAILY_REQUESTED, DAILY_SCHEMA
from squall.sources.tables import (
    read_csv,
    read_observations,
    select_variables,
    source_filter,
    write_csv,
    write_observations,
)
from squall.storage import materialise, scratch_path
from suite.registry import case, day, nums, stamp
from suite.views import (
    DAILY_COLUMNS,
    DAILY_CTE,
    DAILY_GRID_CTE,
    HOURLY_COLUMNS,
    HOURLY_GRID_CTE,
    READINGS_CTE,
    STATION,
    daily,
    daily_grid,
    hourly_grid,
    readings,
)

CSV_COLUMNS = (
    "temperature_2m", "dew_point_2m", "relative_humidity_2m", "precipitation", "rain", "showers",
    "snowfall", "wind_speed_10m", "weather_code",
)
_CSV_SQL = (
    f"with {READINGS_CTE} select event_id, station, {stamp('datetime', 'datetime')}, "
    f"{nums(*CSV_COLUMNS)} from readings"
)


def _csv_rows(spark, sf_dir):
    return readings(spark, sf_dir).select("event_id", "station", "datetime", *CSV_COLUMNS)


@case("scan_csv", _CSV_SQL)
def _scan_csv(spark, sf_dir):
    rows = _csv_rows(spark, sf_dir)
    path = scratch_path(spark, "scan-csv")
    write_csv(rows, path)
    return read_csv(spark, path, rows.schema)


@case("sink_csv", f"with {DAILY_CTE} select station, {day('date', 'date')}, {nums(*DAILY_COLUMNS)} from daily")
def _sink_csv(spark, sf_dir):
    """Overwrites a first version of the table and reads the second one back."""
    path = scratch_path(spark, "sink-csv")
    rows = daily(spark, sf_dir)
    write_csv(rows.select("station", "date"), path)
    write_csv(rows, path)
    return read_csv(spark, path, DAILY_SCHEMA)


def _responses(rows, ts: str, period: str, step: str, seconds: int, cols):
    """Answers of a source: per station and period one record of parallel arrays.

    A period holds a bounded number of rows of the regular axis.
    """
    points = F.sort_array(F.collect_list(F.struct(F.col(ts).alias("at"), *cols)))
    series = F.create_map(*[x for c in cols for x in (F.lit(c), F.col("points")[c])])
    grouped = rows.groupBy("station", F.date_trunc(period, ts).alias("p")).agg(
        points.alias("points")
    )
    first, last = F.col("points")[0]["at"], F.element_at("points", -1)["at"]
    return grouped.select(
        "station",
        first.cast("timestamp").alias("start"),
        (last.cast("timestamp") + F.expr(f"interval {step}")).alias("end"),
        F.lit(seconds).alias("interval_s"),
        series.alias("variables"),
    )


def hourly_responses(spark, sf_dir, cols=HOURLY_COLUMNS):
    path = scratch_path(spark, "hourly-responses")
    answers = _responses(hourly_grid(spark, sf_dir), "datetime", "day", "1 hour", 3_600, cols)
    answers.write.option("ignoreNullFields", False).json(path)
    return read_responses(spark, path)


def daily_responses(spark, sf_dir):
    path = scratch_path(spark, "daily-responses")
    answers = _responses(daily_grid(spark, sf_dir), "date", "year", "1 day", 86_400, DAILY_REQUESTED)
    answers.write.option("ignoreNullFields", False).json(path)
    return read_responses(spark, path)


@case(
    "ingest_hourly",
    f"with {HOURLY_GRID_CTE} select station, {stamp('datetime', 'datetime')}, "
    f"{nums(*HOURLY_COLUMNS[:-1])}, visibility from hourly_grid",
)
def _ingest_hourly(spark, sf_dir):
    rows = ingest_hourly(hourly_responses(spark, sf_dir))
    return rows.select("station", "datetime", *HOURLY_COLUMNS)


@case(
    "ingest_length_violations",
    f"with {HOURLY_GRID_CTE}, periods as (select station, min(datetime) as first, count(*) as points "
    "from hourly_grid group by station, date_trunc('day', datetime)) "
    f"select station, {stamp('first', 'start')}, 'rain' as variable, "
    "cast(points - 1 as int) as n_values, cast(points as int) as n_points "
    "from periods where day(first) % 2 = 0",
)
def _length_violations(spark, sf_dir):
    """Answers of even days lack their last value of rain."""
    answers = hourly_responses(spark, sf_dir, ["temperature_2m", "rain"])
    cut = F.transform_values(
        "variables",
        lambda name, x: F.when(
            (name == "rain") & (F.dayofmonth("start") % 2 == 0), F.slice(x, 1, F.size(x) - 1)
        ).otherwise(x),
    )
    return length_violations(answers.withColumn("variables", cut))


_NOT_REQUESTED = tuple(c for c in DAILY_COLUMNS if c not in DAILY_REQUESTED)


@case(
    "ingest_daily",
    f"with {DAILY_GRID_CTE} select station, {day('date', 'date')}, {nums(*DAILY_REQUESTED)}, "
    + ", ".join(f"cast(null as double) as {c}" for c in _NOT_REQUESTED)
    + " from daily_grid",
)
def _ingest_daily(spark, sf_dir):
    return ingest_daily(daily_responses(spark, sf_dir))


@case(
    "missing_variable_as_null",
    f"with {HOURLY_GRID_CTE} select station, {stamp('datetime', 'datetime')}, "
    f"{nums('temperature_2m')}, cast(null as double) as cape from hourly_grid",
)
def _missing_variable(spark, sf_dir):
    answers = hourly_responses(spark, sf_dir, ["temperature_2m"])
    return ingest_hourly(answers, ["temperature_2m", "cape"])


@case(
    "select_variables",
    f"with {READINGS_CTE} select station, {stamp('datetime', 'datetime')}, "
    f"{nums('temperature_2m', 'rain')}, cast(null as double) as cape from readings",
)
def _select_variables(spark, sf_dir):
    wanted = ["temperature_2m", "rain", "cape"]
    return select_variables(readings(spark, sf_dir), ["station", "datetime"], wanted)


@case(
    "source_filter",
    f"with {READINGS_CTE} select event_id, station, {stamp('datetime', 'datetime')}, "
    f"{nums('temperature_2m')} from readings where datetime between timestamp '2024-01-08 00:00:00' "
    "and timestamp '2024-01-21 23:59:59' and station in ('click', 'view')",
)
def _source_filter(spark, sf_dir):
    """From a stored table partitioned by month, so folders and row groups can be skipped."""
    path = scratch_path(spark, "observations")
    rows = readings(spark, sf_dir).select("event_id", "station", "datetime", "temperature_2m")
    write_observations(rows, path, "datetime")
    stored = read_observations(spark, path)
    picked = source_filter(
        stored, "datetime", "2024-01-08 00:00:00", "2024-01-21 23:59:59", ["click", "view"],
        by_month=True,
    )
    return picked.select(*rows.columns)


@case(
    "source_filter_station_table",
    f"with {READINGS_CTE} select event_id, station from readings where station in "
    "(select station from readings group by 1 having max(temperature_2m) >= 400)",
)
def _source_filter_table(spark, sf_dir):
    rows = readings(spark, sf_dir)
    stations = rows.groupBy("station").agg(F.max("temperature_2m").alias("t")).filter("t >= 400")
    picked = source_filter(rows, "datetime", stations=materialise(stations, "stations"))
    return picked.select("event_id", "station")


@case(
    "observations_round_trip",
    f"with {DAILY_CTE} select station, {day('date', 'date')}, {nums('temperature_2m_max')}, "
    "cast(year(date) as int) as year, cast(month(date) as int) as month from daily",
)
def _round_trip(spark, sf_dir):
    path = scratch_path(spark, "daily-observations")
    rows = daily(spark, sf_dir).select(*STATION, "date", "temperature_2m_max")
    write_observations(rows, path, "date")
    return read_observations(spark, path)


