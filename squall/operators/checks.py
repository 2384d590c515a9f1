"""Data checks as tables: every check counts its violations, nothing is only logged."""

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from squall.operators.eda import null_cells

# Plausible daily temperatures and the columns they apply to.
LOWEST_TEMPERATURE = -100
HIGHEST_TEMPERATURE = 150
MIN_TEMPERATURE_COLUMN = "temperature_2m_min"
MAX_TEMPERATURE_COLUMN = "temperature_2m_max"
PRECIPITATION_COLUMN = "precipitation_sum"

Checks = dict[str, Column]


def violated(expectation: Column) -> Column:
    """1 unless the expectation holds; a null or NaN value does not meet it."""
    return F.when(F.coalesce(expectation, F.lit(False)), 0).otherwise(1)


def _number(col: str) -> Column:
    return F.nanvl(F.col(col).cast("double"), F.lit(None).cast("double"))


def no_nulls(df: DataFrame, tolerated: Sequence[str] = ()) -> Checks:
    return {"no_nulls": null_cells([c for c in df.columns if c not in tolerated])}


def temperature_range(
    df: DataFrame,
    low_col: str = MIN_TEMPERATURE_COLUMN,
    high_col: str = MAX_TEMPERATURE_COLUMN,
    low: float = LOWEST_TEMPERATURE,
    high: float = HIGHEST_TEMPERATURE,
) -> Checks:
    checks = {}
    if low_col in df.columns:
        checks[f"{low_col}_at_least_{low}"] = violated(_number(low_col) >= low)
    if high_col in df.columns:
        checks[f"{high_col}_at_most_{high}"] = violated(_number(high_col) <= high)
    return checks


def non_negative(df: DataFrame, cols: Sequence[str] = (PRECIPITATION_COLUMN,)) -> Checks:
    return {f"{c}_non_negative": violated(_number(c) >= 0) for c in cols if c in df.columns}


def run_checks(df: DataFrame, dataset: str, checks: Checks) -> DataFrame:
    """`(dataset, check, violations, rows, passed)`; all checks in one aggregate."""
    if not checks:
        return df.sparkSession.createDataFrame(
            [], "dataset string, check string, violations bigint, rows bigint, passed boolean"
        )
    counted = df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.array(
            *[
                F.struct(F.lit(name).alias("check"), F.coalesce(F.sum(v), F.lit(0)).alias("violations"))
                for name, v in checks.items()
            ]
        ).alias("checks"),
    )
    return counted.select("rows", F.inline("checks")).select(
        F.lit(dataset).alias("dataset"),
        "check",
        "violations",
        "rows",
        (F.col("violations") == 0).alias("passed"),
    )


def write_checked(df: DataFrame, path: str, checks: Checks | None = None) -> dict[str, int]:
    """Write `df` and count its rows and the violations of every check while doing so.

    Returns `rows` and the checks by name. The counts are taken in the tasks that write, each partition
    counted once however often it is tried, so there is no second pass.
    """
    seen = Observation()
    counts = [F.coalesce(F.sum(v), F.lit(0)).alias(name) for name, v in (checks or {}).items()]
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"), *counts)
    counted.write.mode("overwrite").parquet(path)
    return seen.get


def checks_table(spark: SparkSession, dataset: str, counted: dict[str, int]) -> DataFrame:
    """What `write_checked` counted, in the form of `run_checks`."""
    rows = counted["rows"]
    return spark.createDataFrame(
        [(dataset, name, n, rows, n == 0) for name, n in counted.items() if name != "rows"],
        "dataset string, check string, violations bigint, rows bigint, passed boolean",
    )


def suite(df: DataFrame, tolerated: Sequence[str] = ()) -> Checks:
    """The checks both datasets go through; those without their column do not apply."""
    return no_nulls(df, tolerated) | temperature_range(df) | non_negative(df)


def validate_suite(df: DataFrame, dataset: str, tolerated: Sequence[str] = ()) -> DataFrame:
    return run_checks(df, dataset, suite(df, tolerated))


def quarantine(df: DataFrame, checks: Checks) -> tuple[DataFrame, DataFrame]:
    """Rows that pass every check, and the others."""
    bad = F.lit(0)
    for violations in checks.values():
        bad = bad + violations
    return df.filter(bad == 0), df.filter(bad > 0)


def schema_table(spark: SparkSession, schema: T.StructType) -> DataFrame:
    rows = [(f.name, f.dataType.simpleString()) for f in schema]
    return spark.createDataFrame(rows, "column string, type string")


def check_schema_match(left: DataFrame, right: DataFrame) -> DataFrame:
    """Compare two `(column, type)` tables: `(column, left_type, right_type, status)`."""
    a = left.select("column", F.col("type").alias("left_type"))
    b = right.select("column", F.col("type").alias("right_type"))
    status = (
        F.when(F.col("right_type").isNull(), "missing")
        .when(F.col("left_type").isNull(), "extra")
        .when(F.col("left_type") != F.col("right_type"), "changed")
        .otherwise("same")
    )
    return a.join(b, "column", "full").withColumn("status", status)


def check_schema_artifact(df: DataFrame, stored: str) -> DataFrame:
    """Compare a table with a stored JSON schema.

    Text that is not a schema gives one row with status `unreadable`.
    """
    spark = df.sparkSession
    try:
        schema = T.StructType.fromJson(json.loads(stored))
    except (ValueError, TypeError, KeyError, AttributeError):
        return spark.createDataFrame(
            [(None, None, None, "unreadable")],
            "column string, left_type string, right_type string, status string",
        )
    return check_schema_match(schema_table(spark, schema), schema_table(spark, df.schema))
