"""Compositions: preprocessing, features and whole collection runs."""

from pyspark.sql import functions as F

from squall.plans.collection import collect_daily, collect_hourly, run_daily, run_hourly
from squall.plans.daily import (
    DROPPED_ENGINEERED,
    DROPPED_RAW,
    FORWARD_FILLED,
    daily_features,
)
from squall.plans.daily import preprocess as preprocess_daily
from squall.plans.hourly import hourly_features
from squall.plans.hourly import preprocess as preprocess_hourly
from squall.streaming import read_stream, row_features, write_available
from squall.storage import scratch_path
from suite.checks import PRECIPITATION_SQL, TEMPERATURE_SQL, check_sql, nulls_sql
from suite.frames import boxplot_sql, histogram_sql, kde_sql, profile_sql, shape_sql
from suite.missing import imputed_sql, rolled_hourly_sql
from suite.registry import case, day, num, nums, stamp
from suite.sources import daily_responses, hourly_responses
from suite.views import (
    DAILY_COLUMNS,
    DAILY_GRID_CTE,
    HOURLY_COLUMNS,
    HOURLY_GRID_CTE,
    READINGS_CTE,
    STATION,
    daily_grid,
    hourly_grid,
    readings,
)

SEASON_SQL = (
    "case when month({0}) <= 3 then 'Winter' when month({0}) <= 6 then 'Spring' "
    "when month({0}) <= 9 then 'Summer' else 'Fall' end"
)
WEEKEND_SQL = "cast(isodow({0}) >= 6 as int)"
DAILY_KEPT = tuple(c for c in DAILY_COLUMNS if c not in DROPPED_RAW)
DAILY_ENGINEERED = tuple(c for c in DAILY_KEPT if c not in DROPPED_ENGINEERED)


def _scale(c: str, lo: str, hi: str) -> str:
    return f"round_even(({c} - {lo}) / nullif({hi} - {lo}, 0) * 1000, 0) / 1000"


def _scaled_columns(view: str, cols, keep: str) -> str:
    by = "over (partition by station)"
    values = ", ".join(f"{_scale(c, f'min({c}) {by}', f'max({c}) {by}')} as {c}" for c in cols)
    return f"select {keep}, {values} from {view}"


def _daily_clipped(view: str = "daily_grid") -> str:
    """CTEs up to `clipped`, from `view`: filled forward, limited to the fences, with season and weekend."""
    filled = ", ".join(
        f"last_value({c} ignore nulls) over (partition by station order by date) as {c}"
        for c in FORWARD_FILLED
    )
    quartiles = ", ".join(
        f"quantile_cont({c}, 0.25) as q1_{c}, quantile_cont({c}, 0.75) as q3_{c}"
        for c in DAILY_KEPT
    )
    clipped = ", ".join(
        f"case when {c} is not null then greatest(q1_{c} - 1.5 * (q3_{c} - q1_{c}), "
        f"least(q3_{c} + 1.5 * (q3_{c} - q1_{c}), {c})) end as {c}"
        for c in DAILY_KEPT
    )
    return f"""filled as (select * replace ({filled}) from {view}),
    quartiles as (select station, {quartiles} from filled group by 1),
    clipped as (select station, date, {SEASON_SQL.format('date')} as season,
                       {WEEKEND_SQL.format('date')} as is_weekend, {clipped}
                from filled join quartiles using (station))"""


def _codes(view: str, ts: str) -> str:
    return f"""firsts as (select station, season, min({ts}) as seen from {view} group by 1, 2),
    codes as (select station, season, cast(row_number() over (partition by station
              order by seen, season) - 1 as int) as code from firsts)"""


def _daily_engineered(view: str) -> str:
    """CTEs up to `engineered`, from `view`."""
    return f"""{_codes(view, 'date')},
    limits as (select station, quantile_cont(temperature_2m_max, 0.9) as hot,
               quantile_cont(temperature_2m_min, 0.1) as cold,
               quantile_cont(precipitation_sum, 0.95) as wet from {view} group by 1),
    engineered as (select station, date, is_weekend, code as season, {', '.join(DAILY_ENGINEERED)},
        temperature_2m_max - temperature_2m_min as temperature_range,
        temperature_2m_max - temperature_2m_min as diurnal_temp_range,
        cast(coalesce(temperature_2m_max > hot, false) as int) as is_hot_day,
        cast(coalesce(temperature_2m_min < cold, false) as int) as is_cold_day,
        cast(coalesce(precipitation_sum > 0, false) as int) as is_rainy_day,
        cast(coalesce(precipitation_sum > wet, false) as int) as is_heavy_precipitation,
        precipitation_sum / nullif(precipitation_hours, 0) as precipitation_intensity,
        sunshine_duration / nullif(daylight_duration, 0) as sunshine_ratio,
        rain_sum / nullif(precipitation_sum, 0) as rain_ratio
      from {view} join codes using (station, season) join limits using (station))"""


DERIVED_FLAGS = "is_hot_day, is_cold_day, is_rainy_day, is_heavy_precipitation"
DERIVED = (
    "temperature_range", "diurnal_temp_range", "precipitation_intensity", "sunshine_ratio",
    "rain_ratio",
)
_DAILY_SCALED = (
    "scaled as ("
    + _scaled_columns("clipped", (*DAILY_KEPT, "is_weekend"), "station, date, season")
    + ")"
)


@case(
    "daily_preprocess",
    f"with {DAILY_GRID_CTE}, {_daily_clipped()}, {_DAILY_SCALED} "
    f"select station, {day('date', 'date')}, season, {nums('is_weekend', *DAILY_KEPT)} from scaled",
)
def _daily_preprocess(spark, sf_dir):
    return preprocess_daily(daily_grid(spark, sf_dir), STATION)[0]


_DAILY_BEFORE = (
    f"{DAILY_GRID_CTE}, {_daily_clipped()}, {_DAILY_SCALED}, {_daily_engineered('scaled')}"
)
_DAILY_RESCALED = (
    f"{_daily_engineered('clipped')}, rescaled as ("
    + _scaled_columns(
        "engineered",
        [c for c in DAILY_ENGINEERED if c != "weather_code"],
        f"station, date, season, is_weekend, weather_code, {DERIVED_FLAGS}, {', '.join(DERIVED)}",
    )
    + ")"
)
_DAILY_AFTER = f"{DAILY_GRID_CTE}, {_daily_clipped()}, {_DAILY_RESCALED}"


@case(
    "daily_features",
    f"with {_DAILY_AFTER} select station, {day('date', 'date')}, season, is_weekend, {DERIVED_FLAGS}, "
    f"{nums(*DERIVED, *DAILY_ENGINEERED)} from rescaled",
)
def _daily_features(spark, sf_dir):
    return daily_features(daily_grid(spark, sf_dir), STATION)[0]


@case(
    "daily_features_scaled_first",
    f"with {_DAILY_BEFORE} select station, {day('date', 'date')}, season, {DERIVED_FLAGS}, "
    f"{nums('is_weekend', *DERIVED, *DAILY_ENGINEERED)} from engineered",
)
def _daily_scaled_first(spark, sf_dir):
    return daily_features(daily_grid(spark, sf_dir), STATION, scale="before")[0]


HOURLY_MEASURED = tuple(c for c in HOURLY_COLUMNS if c not in ("visibility", "weather_code"))
HOURLY_FLAGS = ("is_precipitation", "hour", "is_weekend")


def _hourly_filled() -> str:
    """CTEs up to `enriched`: imputed by rule, with flag, season, hour and weekend."""
    return f"""{imputed_sql()},
    enriched as (select * exclude (visibility),
        cast(precipitation > 0 or rain > 0 or showers > 0 or snowfall > 0 as int) as is_precipitation,
        {SEASON_SQL.format('datetime')} as season, cast(hour(datetime) as int) as hour,
        {WEEKEND_SQL.format('datetime')} as is_weekend from imputed)"""


_HOURLY_SCALED = (
    "scaled as ("
    + _scaled_columns(
        "enriched", (*HOURLY_MEASURED, *HOURLY_FLAGS), "station, datetime, season, weather_code"
    )
    + ")"
)


@case(
    "hourly_preprocess",
    f"with {HOURLY_GRID_CTE}, {_hourly_filled()}, {_HOURLY_SCALED} "
    f"select station, {stamp('datetime', 'datetime')}, season, "
    f"{nums('weather_code', *HOURLY_FLAGS, *HOURLY_MEASURED)} from scaled",
)
def _hourly_preprocess(spark, sf_dir):
    return preprocess_hourly(hourly_grid(spark, sf_dir), STATION)[0]


HOURLY_INTS = "month, day_of_week, is_holiday, is_freezing, is_raining, is_snowing"
HOURLY_DERIVED = (
    "temp_rolling_mean_24h", "precip_rolling_sum_24h", "wind_chill", "heat_index",
    "dew_point_depression", "calculated_relative_humidity",
)


def _hourly_engineered(view: str) -> str:
    t, h, d, w = "temperature_2m", "relative_humidity_2m", "dew_point_2m", "wind_speed_10m"
    v = f"pow({w} * 3.6e0, 0.16e0)"
    kept = ", ".join((*HOURLY_MEASURED, *HOURLY_FLAGS, "weather_code"))
    return f"""{_codes(view, 'datetime')},
    engineered as (select station, datetime, {kept}, code as season,
        cast(month(datetime) as int) as month, cast(isodow(datetime) - 1 as int) as day_of_week,
        cast(coalesce(is_weekend = 1, false) or (month(datetime) = 12 and day(datetime) = 25) as int)
          as is_holiday,
        {rolled_hourly_sql(view)},
        cast(coalesce({t} <= 0, false) as int) as is_freezing,
        cast(coalesce(precipitation > 0, false) as int) as is_raining,
        cast(coalesce(snowfall > 0, false) as int) as is_snowing,
        13.12e0 + 0.6215e0 * {t} - 11.37e0 * {v} + 0.3965e0 * {t} * {v} as wind_chill,
        -42.379e0 + 2.04901523e0 * {t} + 10.14333127e0 * {h} - 0.22475541e0 * {t} * {h}
          - 0.00683783e0 * {t} * {t} - 0.05481717e0 * {h} * {h} + 0.00122874e0 * {t} * {t} * {h}
          + 0.00085282e0 * {t} * {h} * {h} - 0.00000199e0 * {t} * {t} * {h} * {h} as heat_index,
        {t} - {d} as dew_point_depression,
        100 * exp(17.625e0 * {d} / (243.04e0 + {d})) / exp(17.625e0 * {t} / (243.04e0 + {t}))
          as calculated_relative_humidity,
        case when {w} <= 0 then null when {w} <= 2 then 'Calm' when {w} <= 5 then 'Light'
             when {w} <= 8 then 'Moderate' when {w} <= 11 then 'Fresh' when {w} is not null
             then 'Strong' end as wind_category
      from {view} join codes using (station, season))"""


@case(
    "hourly_features",
    f"with {HOURLY_GRID_CTE}, {_hourly_filled()}, {_hourly_engineered('enriched')}, rescaled as ("
    + _scaled_columns(
        "engineered",
        HOURLY_MEASURED,
        f"station, datetime, season, weather_code, wind_category, {', '.join(HOURLY_FLAGS)}, "
        f"{HOURLY_INTS}, {', '.join(HOURLY_DERIVED)}",
    )
    + f") select station, {stamp('datetime', 'datetime')}, season, wind_category, "
    f"{', '.join(HOURLY_FLAGS)}, {HOURLY_INTS}, "
    f"{nums('weather_code', *HOURLY_DERIVED, *HOURLY_MEASURED)} from rescaled",
)
def _hourly_features(spark, sf_dir):
    return hourly_features(hourly_grid(spark, sf_dir), STATION)[0]


@case(
    "hourly_features_scaled_first",
    f"with {HOURLY_GRID_CTE}, {_hourly_filled()}, {_HOURLY_SCALED}, {_hourly_engineered('scaled')} "
    f"select station, {stamp('datetime', 'datetime')}, season, wind_category, {HOURLY_INTS}, "
    f"{nums('weather_code', *HOURLY_FLAGS, *HOURLY_DERIVED, *HOURLY_MEASURED)} from engineered",
)
def _hourly_scaled_first(spark, sf_dir):
    return hourly_features(hourly_grid(spark, sf_dir), STATION, scale="before")[0]


_DAILY_OUT = ("station", "date", "season", "is_weekend", *DAILY_ENGINEERED, *DERIVED)


@case(
    "daily_end_to_end",
    f"with {_DAILY_AFTER} "
    + check_sql(
        "daily",
        "rescaled",
        {
            "no_nulls": nulls_sql((*_DAILY_OUT, *DERIVED_FLAGS.split(", "))),
            **TEMPERATURE_SQL,
            **PRECIPITATION_SQL,
        },
    ),
)
def _daily_end_to_end(spark, sf_dir):
    """Validation table at the end of the whole daily run."""
    return collect_daily(daily_grid(spark, sf_dir), STATION).validation


@case(
    "daily_end_to_end_density",
    f"with {_DAILY_AFTER}, {kde_sql('rescaled', 'temperature_2m_max')}",
)
def _daily_density(spark, sf_dir):
    return collect_daily(daily_grid(spark, sf_dir), STATION).temperature_density


_HOURLY_BEFORE = (
    f"{HOURLY_GRID_CTE}, {_hourly_filled()}, {_HOURLY_SCALED}, {_hourly_engineered('scaled')}"
)


@case(
    "hourly_end_to_end",
    f"with {_HOURLY_BEFORE}, {histogram_sql('engineered', 'temperature_2m')}",
)
def _hourly_end_to_end(spark, sf_dir):
    """Temperature distribution at the end of the whole hourly run."""
    collected = collect_hourly(hourly_grid(spark, sf_dir), STATION, scale="before")
    return collected.temperature_histogram


@case(
    "hourly_end_to_end_boxplot",
    f"with {_HOURLY_BEFORE}, {boxplot_sql('engineered', 'season', 'precipitation')}",
)
def _hourly_boxplot(spark, sf_dir):
    collected = collect_hourly(hourly_grid(spark, sf_dir), STATION, scale="before")
    return collected.precipitation_by_season


_PROFILED_INTS = ("season", *HOURLY_INTS.split(", "))
_PROFILED_DOUBLES = ("hour", *HOURLY_DERIVED, *HOURLY_MEASURED)


@case(
    "hourly_end_to_end_profile",
    f"with {_HOURLY_BEFORE} {profile_sql('engineered', _PROFILED_DOUBLES)} union all "
    f"{profile_sql('engineered', _PROFILED_INTS, 'int')}",
)
def _hourly_profile(spark, sf_dir):
    return collect_hourly(hourly_grid(spark, sf_dir), STATION, scale="before").profile


_DAILY_NUMBERS = (
    "season", *DERIVED_FLAGS.split(", "), *DERIVED, *(c for c in DAILY_ENGINEERED if c != "weather_code"),
)


def _manifest_sql(raw: str, view: str, charted: str, rained: str, counts: dict[str, str], checks: str) -> str:
    """SQL of a run's manifest, from the engineered rows in `view` and the counts that follow from columns."""
    n = counts["numbers"]
    listed = {
        "raw": f"(select count(*) from {raw})",
        "scaler": counts["scaler"],
        "correlation": f"{n} * {n}",
        "temperature_histogram": "(select bins from shape)",
        "temperature_density": f"(select 200 from {view} having stddev_samp({charted}) > 0)",
        "precipitation_by_season": f"(select count(distinct season) from {view} where {rained} is not null)",
        "profile": n,
        "schema": "1",
        "schema_check": counts["columns"],
    }
    fixed = " union all ".join(f"select '{a}', cast({c} as bigint), true" for a, c in listed.items())
    return f"""checked as ({checks}), verdict as (select count(*) as checks, bool_and(passed) as passed from checked)
    select 'engineered' as artifact, count(*) as rows, (select passed from verdict) as passed from {view}
    union all select 'validation', (select checks from verdict), (select passed from verdict)
    union all {fixed}"""


# The source is not asked for showers, so they are null in its answers.
_ASKED = f"{DAILY_GRID_CTE}, asked as (select * replace (cast(null as double) as showers_sum) from daily_grid)"


@case(
    "daily_collection_run",
    f"with {_ASKED}, {_daily_clipped('asked')}, {_DAILY_RESCALED}, "
    f"{shape_sql('rescaled', 'temperature_2m_max')}, "
    + _manifest_sql(
        "daily_grid", "rescaled", "temperature_2m_max", "precipitation_sum",
        {
            "numbers": str(len(_DAILY_NUMBERS)),
            "columns": str(len(_DAILY_NUMBERS) + len(("station", "date", "is_weekend", "weather_code"))),
            "scaler": f"(select count(distinct station) * {len(DAILY_KEPT) + 1} from daily_grid)",
        },
        check_sql(
            "daily", "rescaled",
            {
                "no_nulls": nulls_sql((*_DAILY_OUT, *DERIVED_FLAGS.split(", "))),
                **TEMPERATURE_SQL, **PRECIPITATION_SQL,
            },
        ),
    ),
)
def _daily_run(spark, sf_dir):
    """From the answers of a source to the schema check in one call: the manifest of the run."""
    return run_daily(daily_responses(spark, sf_dir), scratch_path(spark, "daily-run")).manifest


_HOURLY_RESCALED = (
    f"{HOURLY_GRID_CTE}, {_hourly_filled()}, {_hourly_engineered('enriched')}, rescaled as ("
    + _scaled_columns(
        "engineered",
        HOURLY_MEASURED,
        f"station, datetime, season, weather_code, wind_category, {', '.join(HOURLY_FLAGS)}, "
        f"{HOURLY_INTS}, {', '.join(HOURLY_DERIVED)}",
    )
    + ")"
)
_HOURLY_NUMBERS = ("season", "hour", *HOURLY_INTS.split(", "), *HOURLY_DERIVED, *HOURLY_MEASURED)
_HOURLY_CATEGORIES = ("weather_code", "is_weekend", "is_precipitation")


@case(
    "hourly_collection_run",
    f"with {_HOURLY_RESCALED}, {shape_sql('rescaled', 'temperature_2m')}, "
    + _manifest_sql(
        "hourly_grid", "rescaled", "temperature_2m", "precipitation",
        {
            "numbers": str(len(_HOURLY_NUMBERS)),
            "columns": str(
                len((*_HOURLY_NUMBERS, *_HOURLY_CATEGORIES, "station", "datetime", "wind_category"))
            ),
            "scaler": "(select count(distinct station) * "
            f"{len((*HOURLY_MEASURED, *HOURLY_FLAGS))} from hourly_grid)",
        },
        check_sql(
            "hourly", "rescaled",
            {
                "no_nulls": nulls_sql(
                    ("station", "datetime", "wind_category", *_HOURLY_CATEGORIES, *_HOURLY_NUMBERS)
                )
            },
        ),
    ),
)
def _hourly_run(spark, sf_dir):
    return run_hourly(hourly_responses(spark, sf_dir), scratch_path(spark, "hourly-run")).manifest


@case(
    "daily_collection_run_drift",
    f"""with {_ASKED}, early as (select * from asked where date < date '1996-01-01'),
    now as (select * from asked),
    {', '.join(
        f"{part}_rows as (with {_daily_clipped(part)}, {_DAILY_RESCALED} select * from rescaled)"
        for part in ('early', 'now')
    )}, figures as ("""
    + " union all ".join(
        f"""select '{c}' as "column", a.n = 0 or b.n = 0 as blank,
        b.nulls / b.rows - a.nulls / a.rows as null_change,
        case when a.std <> 0 then (b.mean - a.mean) / a.std end as mean_shift,
        greatest(a.lo - b.lo, 0) as below, greatest(b.hi - a.hi, 0) as above
        from {', '.join(
            f"(select count(*) as rows, count({c}) as n, (count(*) - count({c}))::double as nulls, "
            f"avg({c}) as mean, stddev_samp({c}) as std, min({c})::double as lo, max({c})::double as hi "
            f"from {part}_rows) {name}"
            for part, name in (('early', 'a'), ('now', 'b'))
        )}"""
        for c in _DAILY_NUMBERS
    )
    + f""") select "column", 'same' as status, {num('null_change')}, {num('mean_shift')},
    {num('case when not blank then below end', 'below')},
    {num('case when not blank then above end', 'above')} from figures""",
)
def _daily_drift(spark, sf_dir):
    """Two runs, the first over the years before 1996: how the second's columns moved."""
    rows = daily_responses(spark, sf_dir)
    before, now = scratch_path(spark, "daily-run"), scratch_path(spark, "daily-run")
    run_daily(rows.filter("start < '1996-01-01'"), before)
    return run_daily(rows, now, previous=before).table("profile_check")


def _kept_sql(scale: str) -> str:
    """Whether each observed column survives: it must not be constant within every station."""
    return " union all ".join(
        f"""select '{scale}' as scale, '{c}' as "column", cast(sum(rows) as bigint) as rows, cast(sum(n) as bigint) as count
        from (select count(*) as rows, count(distinct {c}) as kinds,
                     case when count(distinct {c}) > 1 then count({c}) else 0 end as n
              from flat group by station) having max(kinds) > 1"""
        for c in HOURLY_MEASURED
    )


@case(
    "hourly_constant_columns",
    f"with {HOURLY_GRID_CTE}, {_hourly_filled()}, flat as (select * replace (0 as showers, 5 as cloud_cover) "
    f"from enriched) {_kept_sql('after')} union all {_kept_sql('before')}",
)
def _constant_columns(spark, sf_dir):
    """Observed columns left in either order of scaling, and their values, where two of them are constant."""
    grid = hourly_grid(spark, sf_dir).withColumns({"showers": F.lit(0.0), "cloud_cover": F.lit(5.0)})
    parts = []
    for scale in ("after", "before"):
        rows = hourly_features(grid, STATION, scale=scale)[0]
        kept = [c for c in HOURLY_COLUMNS if c in rows.columns and c != "weather_code"]
        counts = rows.agg(
            F.array(*[
                F.struct(F.lit(c).alias("column"), F.count(F.lit(1)).alias("rows"), F.count(c).alias("count"))
                for c in kept
            ]).alias("found")
        )
        parts.append(counts.select(F.lit(scale).alias("scale"), F.inline("found")))
    return parts[0].unionByName(parts[1])


@case(
    "stream_row_features",
    f"with {READINGS_CTE} select event_id, cast(hour(datetime) as int) as hour, "
    f"{SEASON_SQL.format('datetime')} as season, {WEEKEND_SQL.format('datetime')} as is_weekend, "
    "cast(coalesce(precipitation > 0, false) as int) as is_raining, "
    + num("temperature_2m - dew_point_2m", "dew_point_depression")
    + " from readings",
)
def _stream(spark, sf_dir):
    """Readings stored as files, streamed through the row-wise features into a table."""
    source, out = scratch_path(spark, "stream-in"), scratch_path(spark, "stream-out")
    rows = readings(spark, sf_dir)
    rows.write.parquet(source)
    stream = row_features(read_stream(spark, source, rows.schema))
    wanted = ["event_id", "hour", "season", "is_weekend", "is_raining", "dew_point_depression"]
    write_available(stream.select(*wanted), out, scratch_path(spark, "stream-state"))
    return spark.read.parquet(out)
