"""Data checks."""

from pyspark.sql import functions as F

from squall.operators import checks
from squall.operators.profiles import partial_profile
from squall.storage import materialise
from suite.registry import case
from suite.views import (
    DAILY_COLUMNS,
    DAILY_CTE,
    DAILY_GRID_CTE,
    HOURLY_COLUMNS,
    HOURLY_CTE,
    daily,
    daily_grid,
    hourly,
)


def check_sql(dataset: str, view: str, violations: dict[str, str]) -> str:
    """SQL of `run_checks`: each check with the SQL that counts its violations."""
    return " union all ".join(
        f"select '{dataset}' as dataset, '{name}' as \"check\", "
        f"cast(coalesce({count}, 0) as bigint) as violations, count(*) as rows, "
        f"coalesce({count}, 0) = 0 as passed from {view}"
        for name, count in violations.items()
    )


def nulls_sql(cols) -> str:
    return " + ".join(f"count(*) - count({c})" for c in cols)


TEMPERATURE_SQL = {
    "temperature_2m_min_at_least_-100":
        "count(*) - count(case when temperature_2m_min >= -100 then 1 end)",
    "temperature_2m_max_at_most_150":
        "count(*) - count(case when temperature_2m_max <= 150 then 1 end)",
}
PRECIPITATION_SQL = {
    "precipitation_sum_non_negative":
        "count(*) - count(case when precipitation_sum >= 0 then 1 end)",
}
DAILY_ALL = ("station", "date", *DAILY_COLUMNS)


@case(
    "check_no_nulls",
    f"with {DAILY_GRID_CTE} {check_sql('daily', 'daily_grid', {'no_nulls': nulls_sql(DAILY_ALL)})}",
)
def _no_nulls(spark, sf_dir):
    rows = daily_grid(spark, sf_dir)
    return checks.run_checks(rows, "daily", checks.no_nulls(rows))


@case(
    "check_temperature_range",
    f"with {DAILY_GRID_CTE} {check_sql('daily', 'daily_grid', TEMPERATURE_SQL)}",
)
def _temperature(spark, sf_dir):
    rows = daily_grid(spark, sf_dir)
    return checks.run_checks(rows, "daily", checks.temperature_range(rows))


# Shifted down by 5 so that dry days are below zero and the check has something to find.
@case(
    "check_precipitation_non_negative",
    f"with {DAILY_GRID_CTE}, shifted as (select * replace (precipitation_sum - 5 as precipitation_sum) "
    f"from daily_grid) {check_sql('daily', 'shifted', PRECIPITATION_SQL)}",
)
def _precipitation(spark, sf_dir):
    rows = daily_grid(spark, sf_dir).withColumn(
        "precipitation_sum", F.col("precipitation_sum") - 5
    )
    return checks.run_checks(rows, "daily", checks.non_negative(rows))


_HOURLY_ALL = ("station", "datetime", *HOURLY_COLUMNS)


@case(
    "validate_suite",
    f"with {DAILY_GRID_CTE}, {HOURLY_CTE} "
    + check_sql(
        "daily",
        "daily_grid",
        {"no_nulls": nulls_sql(DAILY_ALL), **TEMPERATURE_SQL, **PRECIPITATION_SQL},
    )
    + " union all "
    + check_sql("hourly", "hourly", {"no_nulls": nulls_sql(_HOURLY_ALL)}),
)
def _suite(spark, sf_dir):
    of_daily = checks.validate_suite(daily_grid(spark, sf_dir), "daily")
    return of_daily.unionByName(checks.validate_suite(hourly(spark, sf_dir), "hourly"))


@case(
    "quarantine",
    f"with {DAILY_GRID_CTE} select station, count(*) as rows from daily_grid "
    "where not coalesce(temperature_2m_min >= -100 and temperature_2m_max <= 150 "
    "and precipitation_sum >= 0, false) group by 1",
)
def _quarantine(spark, sf_dir):
    rows = daily_grid(spark, sf_dir)
    expected = checks.temperature_range(rows) | checks.non_negative(rows)
    return checks.quarantine(rows, expected)[1].groupBy("station").agg(
        F.count(F.lit(1)).alias("rows")
    )


def _profile_types(view: str, cols) -> str:
    return " union all ".join(
        f"select '{c}' as c, lower(any_value(typeof({c}))) as t from {view}" for c in cols
    )


@case(
    "check_schema_match",
    f"""with {DAILY_GRID_CTE}, {HOURLY_CTE},
    a as ({_profile_types('daily_grid', DAILY_COLUMNS)}),
    b as ({_profile_types('hourly', HOURLY_COLUMNS)})
    select coalesce(a.c, b.c) as "column", a.t as left_type, b.t as right_type,
           case when b.t is null then 'missing' when a.t is null then 'extra'
                when a.t <> b.t then 'changed' else 'same' end as status
    from a full join b on a.c = b.c""",
)
def _schema_match(spark, sf_dir):
    """Stored profiles of the daily and the hourly table against each other."""
    left = materialise(partial_profile(daily_grid(spark, sf_dir), DAILY_COLUMNS), "profile")
    right = materialise(partial_profile(hourly(spark, sf_dir), HOURLY_COLUMNS), "profile")
    return checks.check_schema_match(left, right)


@case(
    "check_schema_artifact",
    f"""with {DAILY_CTE},
    t as ({_profile_types('daily', DAILY_ALL)}),
    s as (select c, case when t = 'varchar' then 'string' else t end as t from t)
    select c as "column", t as left_type, case when c <> 'sunset' then t end as right_type,
           case when c = 'sunset' then 'missing' else 'same' end as status from s""",
)
def _schema_artifact(spark, sf_dir):
    """The schema stored with the raw table against the table that a later step wrote."""
    raw = daily(spark, sf_dir)
    written = materialise(raw.drop("sunset"), "daily-later")
    return checks.check_schema_artifact(written, raw.schema.json())
