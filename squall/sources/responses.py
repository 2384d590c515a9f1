"""Answers of a weather source: one record per station and period, parallel arrays per variable."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from squall.operators.axis import time_axis
from squall.operators.columns import nan_to_null
from squall.sources.schemas import DAILY_VARIABLES, HOURLY_VARIABLES, RESPONSE_SCHEMA


def read_responses(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines with the fixed response schema."""
    return spark.read.schema(RESPONSE_SCHEMA).option("mode", "FAILFAST").json(path)


def responses_to_rows(responses: DataFrame, ts: str, variables: Sequence[str]) -> DataFrame:
    """One row per station and axis point, variables matched by name.

    A variable the response lacks gives nulls. An array of another length than the axis fails the query:
    its values cannot be placed. `length_violations` lists such arrays.
    """
    step = F.make_dt_interval(secs=F.col("interval_s"))
    axis = time_axis(F.col("start"), F.col("end"), step)
    # The axis first, so that it is built once and not for every variable that is measured against it.
    arrays = responses.select("station", axis.alias(ts), F.col("variables").alias("__variables"))
    asked = F.map_filter("__variables", lambda name, x: name.isin(list(variables)) & x.isNotNull())
    misfits = F.map_filter(asked, lambda name, x: F.size(x) != F.size(ts))
    named = F.map_entries(misfits)[0]
    refused = F.raise_error(
        F.format_string(
            "%s of %s has %d values on an axis of %d",
            named["key"], "station", F.size(named["value"]), F.size(ts),
        )
    )
    checked = arrays.withColumn(ts, F.when(F.size(misfits) == 0, F.col(ts)).when(misfits.isNull(), F.col(ts)).otherwise(refused))
    empty = F.array().cast("array<double>")
    series = [F.coalesce(F.col("__variables")[v], empty).alias(v) for v in variables]
    zipped = checked.select("station", ts, *series).select("station", F.inline(F.arrays_zip(ts, *variables)))
    return nan_to_null(zipped.filter(F.col(ts).isNotNull()))


def length_violations(responses: DataFrame) -> DataFrame:
    """`(station, start, variable, n_values, n_points)` of each array whose length is not its axis's."""
    step = F.make_dt_interval(secs=F.col("interval_s"))
    axis = time_axis(F.col("start"), F.col("end"), step)
    arrays = responses.select(
        "station", "start", F.size(axis).alias("n_points"), F.explode("variables").alias("variable", "values")
    )
    return arrays.filter("values is not null and size(values) <> n_points").select(
        "station", "start", "variable", F.size("values").alias("n_values"), "n_points"
    )


def ingest_hourly(responses: DataFrame, variables: Sequence[str] = HOURLY_VARIABLES) -> DataFrame:
    return responses_to_rows(responses, "datetime", variables)


def ingest_daily(responses: DataFrame, variables: Sequence[str] = DAILY_VARIABLES) -> DataFrame:
    rows = responses_to_rows(responses, "date", variables)
    return rows.withColumn("date", F.col("date").cast("date"))
