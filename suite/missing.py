"""Missing values and rolling figures, on readings with one row per event."""

from squall.operators.missing import (
    ffill,
    fill_mean,
    fill_zero,
    impute_by_rule,
    interpolate_time,
)
from squall.operators.rolling import rolling_mean, rolling_sum
from suite.registry import case, day, num, nums, stamp
from suite.views import (
    DAILY_GRID_CTE,
    HOURLY_GRID_CTE,
    READINGS_CTE,
    STATION,
    daily_grid,
    hourly_grid,
    readings,
)

AXIS = {"ts": "datetime", "keys": STATION, "ties": ["event_id"]}
FILLED = ("temperature_2m", "rain")

_last = "last_value({c} ignore nulls) over (partition by station order by datetime, event_id)"


@case(
    "ffill",
    f"with {READINGS_CTE} select event_id, "
    + ", ".join(num(_last.format(c=c), c) for c in FILLED)
    + " from readings",
)
def _ffill(spark, sf_dir):
    return ffill(readings(spark, sf_dir), FILLED, **AXIS).select("event_id", *FILLED)


@case(
    "ffill_daily",
    f"with {DAILY_GRID_CTE} select station, {day('date', 'date')}, "
    + num(
        "last_value(temperature_2m_max ignore nulls) over (partition by station order by date)",
        "temperature_2m_max",
    )
    + " from daily_grid",
)
def _ffill_daily(spark, sf_dir):
    cols = ["temperature_2m_max"]
    return ffill(daily_grid(spark, sf_dir), cols, ts="date", keys=STATION).select(
        *STATION, "date", *cols
    )


def _interpolated(view: str, order: str, c: str) -> str:
    """SQL rows of `view` with `p0, t0, p1, t1`: the known points around each row."""
    before = f"over (partition by station order by {order} rows unbounded preceding)"
    after = (
        f"over (partition by station order by {order} rows between current row and unbounded following)"
    )
    point = f"case when {c} is not null then {{}} end"
    at = point.format("epoch_us(datetime) / 1000000e0")
    return f"""select *, epoch_us(datetime) / 1000000e0 as t,
      last_value({c} ignore nulls) {before} as p0, last_value({at} ignore nulls) {before} as t0,
      first_value({c} ignore nulls) {after} as p1, first_value({at} ignore nulls) {after} as t1
      from {view}"""


def _line(c: str) -> str:
    return f"coalesce({c}, p0 + (p1 - p0) * ((t - t0) / nullif(t1 - t0, 0)), p0)"


@case(
    "interpolate_time",
    f"with {READINGS_CTE}, near as ({_interpolated('readings', 'datetime, event_id', 'temperature_2m')}) "
    f"select event_id, {num(_line('temperature_2m'), 'temperature_2m')} from near",
)
def _interpolate(spark, sf_dir):
    cols = ["temperature_2m"]
    return interpolate_time(readings(spark, sf_dir), cols, **AXIS).select("event_id", *cols)


@case(
    "interpolate_time_hourly",
    f"with {HOURLY_GRID_CTE}, near as ({_interpolated('hourly_grid', 'datetime', 'temperature_2m')}) "
    f"select station, {stamp('datetime', 'datetime')}, "
    f"{num(_line('temperature_2m'), 'temperature_2m')} from near",
)
def _interpolate_hourly(spark, sf_dir):
    cols = ["temperature_2m"]
    rows = interpolate_time(hourly_grid(spark, sf_dir), cols, ts="datetime", keys=STATION)
    return rows.select(*STATION, "datetime", *cols)


@case(
    "fill_zero",
    f"with {READINGS_CTE} select event_id, {num('coalesce(rain, 0)', 'rain')} from readings",
)
def _fill_zero(spark, sf_dir):
    return fill_zero(readings(spark, sf_dir), ["rain"]).select("event_id", "rain")


@case(
    "fill_mean",
    f"with {READINGS_CTE} select event_id, "
    + num(
        "coalesce(temperature_2m, avg(temperature_2m) over (partition by station))",
        "temperature_2m",
    )
    + " from readings",
)
def _fill_mean(spark, sf_dir):
    rows = fill_mean(readings(spark, sf_dir), ["temperature_2m"], STATION)
    return rows.select("event_id", "temperature_2m")


IMPUTED_ZERO = ("precipitation", "rain", "showers", "snowfall")
IMPUTED_MEAN = ("wind_speed_10m", "cloud_cover", "weather_code")
IMPUTED_LINE = ("temperature_2m", "relative_humidity_2m", "surface_pressure", "apparent_temperature")


def imputed_sql(view: str = "hourly_grid") -> str:
    """CTEs that impute the hourly grid by rule; the last one is `imputed`."""
    steps, source = [], view
    for i, c in enumerate(IMPUTED_LINE):
        near = _interpolated(source, "datetime", c)
        steps.append(f"near{i} as ({near})")
        steps.append(
            f"line{i} as (select * exclude (t, p0, t0, p1, t1) replace ({_line(c)} as {c}) from near{i})"
        )
        source = f"line{i}"
    zero = ", ".join(f"coalesce({c}, 0) as {c}" for c in IMPUTED_ZERO)
    mean = ", ".join(
        f"coalesce({c}, avg({c}) over (partition by station)) as {c}"
        for c in (*IMPUTED_MEAN, "dew_point_2m")
    )
    steps.append(f"imputed as (select * replace ({zero}, {mean}) from {source})")
    return ", ".join(steps)


IMPUTED = (*IMPUTED_ZERO, *IMPUTED_MEAN, *IMPUTED_LINE, "dew_point_2m")


@case(
    "impute_by_rule",
    f"with {HOURLY_GRID_CTE}, {imputed_sql()} "
    f"select station, {stamp('datetime', 'datetime')}, {nums(*IMPUTED)}, visibility from imputed",
)
def _impute(spark, sf_dir):
    rows = impute_by_rule(
        hourly_grid(spark, sf_dir), [*IMPUTED, "visibility"], ts="datetime", keys=STATION
    )
    return rows.select(*STATION, "datetime", *IMPUTED, "visibility")


def _rolled(fn: str, c: str) -> str:
    frame = "over (partition by station order by datetime, event_id rows 23 preceding)"
    return f"case when count({c}) {frame} = 24 then {fn}({c}) {frame} end"


@case(
    "rolling_mean_24h",
    f"with {READINGS_CTE} select event_id, "
    f"{num(_rolled('avg', 'temperature_2m'), 'temp_rolling_mean_24h')} from readings",
)
def _rolling_mean(spark, sf_dir):
    rows = readings(spark, sf_dir)
    return rolling_mean(rows, "temperature_2m", "temp_rolling_mean_24h", **AXIS).select(
        "event_id", "temp_rolling_mean_24h"
    )


@case(
    "rolling_sum_24h",
    f"with {READINGS_CTE} select event_id, "
    f"{num(_rolled('sum', 'precipitation'), 'precip_rolling_sum_24h')} from readings",
)
def _rolling_sum(spark, sf_dir):
    rows = readings(spark, sf_dir)
    return rolling_sum(rows, "precipitation", "precip_rolling_sum_24h", **AXIS).select(
        "event_id", "precip_rolling_sum_24h"
    )


def rolled_hourly_sql(view: str) -> str:
    """The two rolling columns of the hourly table, for reuse in larger queries."""
    frame = "over (partition by station order by datetime rows 23 preceding)"
    return (
        f"case when count(temperature_2m) {frame} = 24 then avg(temperature_2m) {frame} end "
        f"as temp_rolling_mean_24h, case when count(precipitation) {frame} = 24 "
        f"then sum(precipitation) {frame} end as precip_rolling_sum_24h"
    )


