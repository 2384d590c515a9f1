"""Projections, filters, scaling and statistics."""

from pyspark.sql import functions as F

from squall.operators import columns
from squall.operators.axis import fill_gaps, regular_grid, time_axis
from squall.operators.eda import (
    boxplot,
    correlation_matrix,
    histogram,
    kde,
    null_profile,
    profile,
    scatter_cells,
)
from squall.operators.profiles import merge_profiles, partial_profile, profile_figures
from squall.operators.quantiles import quantiles
from squall.operators.scaling import (
    iqr_bounds,
    iqr_clip,
    minmax_fit,
    minmax_inverse,
    minmax_scale,
)
from squall.operators.stats import global_min_max
from squall.functions.binning import season
from squall.storage import materialise, scratch_path
from suite.registry import ORACLES, case, day, num, nums, stamp
from suite.views import (
    DAILY_COLUMNS,
    DAILY_CTE,
    DAILY_GRID_CTE,
    HOURLY_CTE,
    READINGS_CTE,
    STATION,
    daily,
    daily_grid,
    hourly,
    readings,
)

MEASURED = (
    "temperature_2m", "dew_point_2m", "relative_humidity_2m", "precipitation", "rain", "showers",
    "snowfall", "wind_speed_10m", "weather_code",
)


@case(
    "time_axis",
    f"""with {HOURLY_CTE}
    select station, {stamp('t', 'datetime')}
    from (select station, unnest(range(min(datetime), max(datetime), interval 1 hour)) as t
          from hourly group by station)""",
)
def _time_axis(spark, sf_dir):
    limits = hourly(spark, sf_dir).groupBy("station").agg(F.min("datetime").alias("lo"), F.max("datetime").alias("hi"))
    axis = time_axis(F.col("lo"), F.col("hi"), F.expr("interval 1 hour"))
    return limits.select("station", F.explode(axis).alias("datetime"))


@case(
    "regular_grid",
    f"""with {HOURLY_CTE}
    select s.station, {stamp('a.t', 'datetime')}, h.station is not null as observed
    from (select distinct station from hourly) s
    cross join (select unnest(generate_series(min(datetime), max(datetime), interval 1 hour)) as t
                from hourly) a
    left join hourly h on h.station = s.station and h.datetime = a.t""",
)
def _regular_grid(spark, sf_dir):
    rows = hourly(spark, sf_dir).select("station", "datetime", F.lit(True).alias("observed"))
    grid = regular_grid(rows, "datetime", "1 hour", STATION)
    return grid.withColumn("observed", F.coalesce("observed", F.lit(False)))


@case(
    "fill_gaps",
    f"""with {HOURLY_CTE},
    span as (select station, min(datetime) as lo, max(datetime) as hi from hourly
             where hour(datetime) % 7 <> 3 group by 1),
    points as (select station, unnest(generate_series(lo, hi, interval 1 hour)) as t from span)
    select p.station, {stamp('p.t', 'datetime')}, {nums('temperature_2m', 'visibility')}
    from points p left join (select * from hourly where hour(datetime) % 7 <> 3) h
      on h.station = p.station and h.datetime = p.t""",
)
def _fill_gaps(spark, sf_dir):
    """Hours missing from readings of some hours of the day, each station over its own span."""
    rows = hourly(spark, sf_dir).filter("hour(datetime) % 7 <> 3")
    stored = materialise(rows.select("station", "datetime", "temperature_2m", "visibility"), "hourly")
    return fill_gaps(stored, "datetime", "1 hour", STATION)


@case(
    "drop_columns",
    f"with {READINGS_CTE} select event_id, station, {stamp('datetime', 'datetime')}, "
    f"{nums('temperature_2m')} from readings",
)
def _drop_columns(spark, sf_dir):
    dropped = [c for c in MEASURED if c != "temperature_2m"]
    return columns.drop_columns(readings(spark, sf_dir), [*dropped, "user_id"])


@case(
    "drop_all_null_columns",
    f"with {HOURLY_CTE} select station, {stamp('datetime', 'datetime')}, "
    f"{nums('cloud_cover', 'weather_code')} from hourly",
)
def _drop_all_null(spark, sf_dir):
    rows = hourly(spark, sf_dir).select(
        "station", "datetime", "cloud_cover", "visibility", "weather_code"
    )
    return columns.drop_all_null_columns(rows)


@case(
    "select_numeric",
    f"with {READINGS_CTE} select event_id, user_id, {nums(*MEASURED)} from readings",
)
def _select_numeric(spark, sf_dir):
    return columns.select_numeric(readings(spark, sf_dir))


@case(
    "cast_category",
    f"with {READINGS_CTE} select event_id, {nums(*[c for c in MEASURED if c != 'weather_code'])} "
    "from readings",
)
def _cast_category(spark, sf_dir):
    rows = columns.as_category(readings(spark, sf_dir), ["weather_code", "user_id"])
    return columns.select_numeric(rows)


@case(
    "select_features",
    f"with {READINGS_CTE} select user_id, {nums('wind_speed_10m', 'temperature_2m')} from readings",
)
def _select_features(spark, sf_dir):
    return columns.select_features(
        readings(spark, sf_dir), ["user_id", "wind_speed_10m"], "temperature_2m"
    )


@case(
    "mark_selected",
    f"with {DAILY_CTE} select station, {day('date', 'date')}, "
    "date = date '1996-02-29' as \"Selected\" from daily",
)
def _mark_selected(spark, sf_dir):
    rows = daily(spark, sf_dir).select("station", "date")
    return columns.mark_selected(rows, "date", "1996-02-29")


@case(
    "forecast_horizon_filter",
    f"with {DAILY_CTE} select station, {day('date', 'date')}, {nums('temperature_2m_max')} "
    "from daily where date between date '1997-12-28' and date '1997-12-28' + interval 7 day",
)
def _horizon(spark, sf_dir):
    rows = daily(spark, sf_dir).select("station", "date", "temperature_2m_max")
    return columns.within_horizon(rows, "date", "1997-12-28")


_BOUNDS = """bounds as (
  {}),
  fences as (select *, q1 - 1.5 * (q3 - q1) as lo, q3 + 1.5 * (q3 - q1) as hi from bounds)"""


def _bounds_sql(view: str, cols, key: str = "station") -> str:
    parts = [
        f"select {key}, '{c}' as \"column\", quantile_cont({c}, 0.25) as q1, "
        f"quantile_cont({c}, 0.75) as q3 from {view} group by 1"
        for c in cols
    ]
    return _BOUNDS.format(" union all ".join(parts))


CLIPPED = MEASURED


@case(
    "iqr_bounds",
    f"with {READINGS_CTE}, {_bounds_sql('readings', CLIPPED)} "
    f"select station, \"column\", {nums('q1', 'q3', 'lo', 'hi')} from fences",
)
def _iqr_bounds(spark, sf_dir):
    return iqr_bounds(readings(spark, sf_dir), CLIPPED, STATION)


@case("iqr_bounds_large", ORACLES["iqr_bounds"])
def _iqr_bounds_large(spark, sf_dir):
    """As for groups too large for one task, whatever their size here."""
    return iqr_bounds(readings(spark, sf_dir), CLIPPED, STATION, max_values_in_task=0)


def _clip_sql(view: str, cols) -> str:
    quartiles = ", ".join(
        f"quantile_cont({c}, 0.25) as q1_{c}, quantile_cont({c}, 0.75) as q3_{c}" for c in cols
    )
    values = ", ".join(
        f"case when {c} is not null then greatest(q1_{c} - 1.5 * (q3_{c} - q1_{c}), "
        f"least(q3_{c} + 1.5 * (q3_{c} - q1_{c}), {c})) end as {c}"
        for c in cols
    )
    return f"""quartiles as (select station, {quartiles} from {view} group by 1),
    clipped as (select {view}.* replace ({values}) from {view} join quartiles using (station))"""


@case(
    "iqr_clip",
    f"with {READINGS_CTE}, {_clip_sql('readings', CLIPPED)} "
    f"select event_id, {nums(*CLIPPED)} from clipped",
)
def _iqr_clip(spark, sf_dir):
    return iqr_clip(readings(spark, sf_dir), CLIPPED, STATION).select("event_id", *CLIPPED)


@case("iqr_clip_large", ORACLES["iqr_clip"])
def _iqr_clip_large(spark, sf_dir):
    clipped = iqr_clip(readings(spark, sf_dir), CLIPPED, STATION, max_values_in_task=0)
    return clipped.select("event_id", *CLIPPED)


@case(
    "quantiles",
    f"with {READINGS_CTE} select c as \"column\", p, {num('v', 'value')} from ("
    + " union all ".join(
        f"select '{c}' as c, cast({p} as double) as p, quantile_cont({c}, {p}) as v from readings"
        for c in CLIPPED
        for p in (0.1, 0.5, 0.95)
    )
    + ")",
)
def _quantiles(spark, sf_dir):
    # The distributed path for groups of any size, whatever the size here.
    return quantiles(
        readings(spark, sf_dir), CLIPPED, [0.1, 0.5, 0.95], max_values_in_task=0
    )


def _scaled(c: str, partition: str = "partition by station") -> str:
    low, high = f"min({c}) over ({partition})", f"max({c}) over ({partition})"
    return f"round_even(({c} - {low}) / nullif({high} - {low}, 0) * 1000, 0) / 1000"


SCALED = MEASURED


@case(
    "minmax_scale",
    f"with {READINGS_CTE} select event_id, "
    + ", ".join(num(_scaled(c), c) for c in SCALED)
    + " from readings",
)
def _minmax_scale(spark, sf_dir):
    return minmax_scale(readings(spark, sf_dir), SCALED, STATION).select("event_id", *SCALED)


@case(
    "minmax_fit",
    f"with {READINGS_CTE} select station, c as \"column\", {num('lo', 'min')}, {num('hi', 'max')} from ("
    + " union all ".join(
        f"select station, '{c}' as c, min({c}) as lo, max({c}) as hi from readings group by 1"
        for c in ("precipitation", "rain")
    )
    + ")",
)
def _minmax_fit(spark, sf_dir):
    targets = ["apparent_temperature_max", "apparent_temperature", "precipitation", "rain"]
    return minmax_fit(readings(spark, sf_dir), targets, STATION)


@case(
    "minmax_inverse",
    f"with {READINGS_CTE}, s as (select event_id, temperature_2m, "
    "min(temperature_2m) over (partition by station) as lo, "
    "max(temperature_2m) over (partition by station) as hi from readings), "
    "u as (select event_id, lo, hi, "
    "round_even((temperature_2m - lo) / nullif(hi - lo, 0) * 1000, 0) / 1000 as v from s) "
    f"select event_id, {num('v * (hi - lo) + lo', 'temperature_2m')} from u",
)
def _minmax_inverse(spark, sf_dir):
    rows, cols = readings(spark, sf_dir), ["temperature_2m"]
    scaler = minmax_fit(rows, cols, STATION)
    scaled = minmax_scale(rows, cols, STATION, scaler)
    return minmax_inverse(scaled, scaler, cols, STATION).select("event_id", *cols)


@case(
    "global_min_max",
    f"with {READINGS_CTE} select c as \"column\", {num('lo', 'min')}, {num('hi', 'max')} from ("
    + " union all ".join(
        f"select '{c}' as c, cast(min({c}) as double) as lo, cast(max({c}) as double) as hi "
        "from readings"
        for c in MEASURED
    )
    + ")",
)
def _global_min_max(spark, sf_dir):
    return global_min_max(readings(spark, sf_dir), MEASURED)


@case(
    "null_profile",
    f"with {READINGS_CTE} select "
    + " + ".join(f"count(*) - count({c})" for c in MEASURED)
    + " as null_cells from readings",
)
def _null_profile(spark, sf_dir):
    return null_profile(readings(spark, sf_dir), MEASURED)


CORRELATED = (*MEASURED, "user_id")


@case(
    "correlation_matrix",
    f"with {READINGS_CTE}, flat as (select *, 5 as constant from readings), c as ("
    + " union all ".join(
        f"select '{a}' as col_a, '{b}' as col_b, corr({a}, {b}) as r from flat"
        for a in (*CORRELATED, "constant")
        for b in (*CORRELATED, "constant")
    )
    + f") select col_a, col_b, {num('case when not isnan(r) then r end', 'corr')} from c",
)
def _correlation(spark, sf_dir):
    rows = readings(spark, sf_dir).withColumn("constant", F.lit(5))
    return correlation_matrix(rows, [*CORRELATED, "constant"])


def shape_sql(view: str, c: str) -> str:
    return f"""
    q as (select count({c}) as n, min({c}) as lo, max({c}) as hi,
                 quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) as iqr from {view}),
    shape as (select n, lo, hi, cast(ceil((hi - lo) / least(
                case when iqr > 0 then 2 * iqr / cbrt(n) else (hi - lo) / (log2(n) + 1) end,
                (hi - lo) / (log2(n) + 1))) as bigint) as bins from q)"""


def histogram_sql(view: str, c: str) -> str:
    return f"""{shape_sql(view, c)},
    counts as (select least(cast(floor(({c} - lo) / (hi - lo) * bins) as bigint), bins - 1) as bin,
                      count(*) as n
               from {view}, shape where {c} is not null group by 1)
    select b.bin, {num('lo + (hi - lo) * b.bin / bins', 'left')},
           {num('lo + (hi - lo) * (b.bin + 1) / bins', 'right')}, coalesce(c.n, 0) as count
    from (select lo, hi, bins, unnest(generate_series(0, bins - 1)) as bin from shape) b
    left join counts c on c.bin = b.bin"""


@case("histogram", f"with {READINGS_CTE}, {histogram_sql('readings', 'temperature_2m')}")
def _histogram(spark, sf_dir):
    return histogram(readings(spark, sf_dir), "temperature_2m")


@case("histogram_large", ORACLES["histogram"])
def _histogram_large(spark, sf_dir):
    return histogram(readings(spark, sf_dir), "temperature_2m", max_values_in_task=0)


@case(
    "histogram_daily",
    f"with {DAILY_CTE}, {histogram_sql('daily', 'temperature_2m_max')}",
)
def _histogram_daily(spark, sf_dir):
    return histogram(daily(spark, sf_dir), "temperature_2m_max")


def kde_sql(view: str, c: str) -> str:
    return f"""
    s as (select count({c}) as n, min({c}) as lo, max({c}) as hi,
                 stddev_samp({c}) * pow(count({c}), -0.2e0) as h from {view}),
    v as (select {c} as v, count(*) as m from {view} where {c} is not null group by 1),
    grid as (select n, h, point, lo + (hi - lo) * point / 199 as x
             from s, (select unnest(generate_series(0, 199)) as point))
    select cast(point as int) as point, {num('x')}, {num('sum(m * k) / any_value(n)', 'density')}
    from (select point, x, n, m,
                 exp(-((x - v) / h) * ((x - v) / h) / 2) / (h * sqrt(2 * pi())) as k from grid, v)
    group by point, x"""


@case("kde", f"with {READINGS_CTE}, {kde_sql('readings', 'temperature_2m')}")
def _kde(spark, sf_dir):
    return kde(readings(spark, sf_dir), "temperature_2m")


def boxplot_sql(view: str, by: str, c: str) -> str:
    return f"""
    q as (select {by}, quantile_cont({c}, 0.25) as q1, quantile_cont({c}, 0.5) as median,
                 quantile_cont({c}, 0.75) as q3 from {view}
          where {by} is not null and {c} is not null group by 1),
    f as (select {by}, {c} as x, q1, median, q3,
                 {c} between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1) as inside
          from {view} join q using ({by}) where {c} is not null),
    b as (select {by}, q1, median, q3, count(*) as n, min(case when inside then x end) as lo,
                 max(case when inside then x end) as hi, count(case when not inside then 1 end) as outliers
          from f group by 1, 2, 3, 4)
    select {by}, n, {num('least(lo, q1)', 'whisker_low')}, {nums('q1', 'median', 'q3')},
           {num('greatest(hi, q3)', 'whisker_high')}, outliers from b"""


SEASONED = (
    "seasoned as (select *, case when month(date) <= 3 then 'Winter' when month(date) <= 6 "
    "then 'Spring' when month(date) <= 9 then 'Summer' else 'Fall' end as season from daily)"
)


@case(
    "boxplot_by_season",
    f"with {DAILY_CTE}, {SEASONED}, {boxplot_sql('seasoned', 'season', 'precipitation_sum')}",
)
def _boxplot(spark, sf_dir):
    rows = daily(spark, sf_dir).withColumn("season", season(F.col("date")))
    return boxplot(rows, "season", "precipitation_sum")


@case(
    "boxplot_by_station",
    f"with {READINGS_CTE}, {boxplot_sql('readings', 'station', 'temperature_2m')}",
)
def _boxplot_station(spark, sf_dir):
    return boxplot(readings(spark, sf_dir), "station", "temperature_2m")


@case("boxplot_by_station_large", ORACLES["boxplot_by_station"])
def _boxplot_station_large(spark, sf_dir):
    return boxplot(readings(spark, sf_dir), "station", "temperature_2m", max_values_in_task=0)


@case(
    "scatter_actual_predicted",
    f"""with {READINGS_CTE},
    pairs as (select temperature_2m as a, dew_point_2m * 2 + 40 as p from readings
              where temperature_2m is not null),
    e as (select least(min(a), min(p)) as lo, greatest(max(a), max(p)) as hi from pairs),
    cells as (select cast(least(floor((a - lo) / (hi - lo) * 50), 49) as bigint) as actual_bin,
                     cast(least(floor((p - lo) / (hi - lo) * 50), 49) as bigint) as predicted_bin,
                     lo, hi, count(*) as n from pairs, e group by 1, 2, 3, 4)
    select actual_bin, predicted_bin,
           {num('lo + (hi - lo) * (actual_bin + 0.5) / 50', 'actual_mid')},
           {num('lo + (hi - lo) * (predicted_bin + 0.5) / 50', 'predicted_mid')}, n from cells""",
)
def _scatter(spark, sf_dir):
    rows = readings(spark, sf_dir).withColumn("predicted", F.col("dew_point_2m") * 2 + 40)
    return scatter_cells(rows, "temperature_2m", "predicted")


def profile_sql(view: str, cols, kind: str = "double") -> str:
    return " union all ".join(
        f"""select '{c}' as "column", '{kind}' as type, count({c}) as count,
        count(*) - count({c}) as nulls, {num(f'avg({c})', 'mean')}, {num(f'stddev_samp({c})', 'std')},
        {num(f'min({c})', 'min')}, {num(f'quantile_cont({c}, 0.25)', 'q1')},
        {num(f'quantile_cont({c}, 0.5)', 'median')}, {num(f'quantile_cont({c}, 0.75)', 'q3')},
        {num(f'max({c})', 'max')} from {view}"""
        for c in cols
    )


@case(
    "profile_and_schema",
    f"with {DAILY_GRID_CTE} {profile_sql('daily_grid', DAILY_COLUMNS)}",
)
def _profile(spark, sf_dir):
    """Of every measured column, stored and read back."""
    path = scratch_path(spark, "profile")
    profile(daily_grid(spark, sf_dir), DAILY_COLUMNS).write.parquet(path)
    return spark.read.parquet(path)


def _figures_sql(view: str, cols) -> str:
    return " union all ".join(
        f"""select '{c}' as "column", 'double' as type, count(*) as rows, count({c}) as count,
        count(*) - count({c}) as nulls, {num(f'avg({c})', 'mean')}, {num(f'stddev_samp({c})', 'std')},
        {num(f'min({c})', 'min')}, {num(f'max({c})', 'max')} from {view}"""
        for c in cols
    )


@case(
    "profile_merged",
    f"with {DAILY_GRID_CTE} {_figures_sql('daily_grid', DAILY_COLUMNS)}",
)
def _profile_merged(spark, sf_dir):
    """Profiles of each year, stored run by run, read back and added up; quartiles by sketch are left to tests."""
    path, rows = scratch_path(spark, "profiles"), daily_grid(spark, sf_dir)
    for part in ("year(date) < 1994", "year(date) between 1994 and 1996", "year(date) > 1996"):
        partial_profile(rows.filter(part), DAILY_COLUMNS).write.mode("append").parquet(path)
    merged = profile_figures(merge_profiles(spark.read.parquet(path)))
    return merged.drop("q1", "median", "q3")


@case(
    "profile_readings",
    f"with {READINGS_CTE} {profile_sql('readings', MEASURED)}",
)
def _profile_readings(spark, sf_dir):
    return profile(readings(spark, sf_dir), MEASURED)
