import datetime as dt

import pytest
from pyspark.sql import functions as F

from squall.operators import checks


@pytest.fixture
def bad(spark):
    rows = [
        (dt.date(2024, 1, 1), 10.0, 20.0, 1.0),
        (dt.date(2024, 1, 2), -101.0, 151.0, -0.1),
        (dt.date(2024, 1, 3), None, None, None),
        (dt.date(2024, 1, 4), float("nan"), float("nan"), float("nan")),
    ]
    return spark.createDataFrame(
        rows,
        "date date, temperature_2m_min double, temperature_2m_max double, precipitation_sum double",
    )


def test_suite_counts_every_violation(bad):
    got = {r.check: (r.violations, r.rows, r.passed) for r in checks.validate_suite(bad, "d").collect()}
    assert got == {
        "no_nulls": (3, 4, False),
        "temperature_2m_min_at_least_-100": (3, 4, False),
        "temperature_2m_max_at_most_150": (3, 4, False),
        "precipitation_sum_non_negative": (3, 4, False),
    }


def test_good_rows_pass(bad):
    got = checks.validate_suite(bad.limit(1), "d").collect()
    assert all(r.passed and r.violations == 0 for r in got)


def test_tolerated_columns_and_absent_columns(spark):
    df = spark.createDataFrame([(None, 1.0)], "a double, b double")
    got = checks.validate_suite(df, "d", tolerated=["a"]).collect()
    assert [(r.check, r.passed) for r in got] == [("no_nulls", True)]
    assert checks.run_checks(df, "d", {}).count() == 0


def test_empty_table_passes(bad):
    got = checks.validate_suite(bad.filter("false"), "d").collect()
    assert [(r.violations, r.rows) for r in got] == [(0, 0)] * 4


def test_quarantine_splits_rows(bad):
    good, rest = checks.quarantine(bad, checks.temperature_range(bad))
    assert (good.count(), rest.count()) == (1, 3)


def test_schema_match(spark):
    a = spark.createDataFrame([], "x double, y int, z string")
    b = spark.createDataFrame([], "x double, y bigint, w string")
    table = checks.check_schema_match(
        checks.schema_table(spark, a.schema), checks.schema_table(spark, b.schema)
    )
    assert {r.column: r.status for r in table.collect()} == {
        "x": "same", "y": "changed", "z": "missing", "w": "extra",
    }


def test_schema_artifact(spark):
    df = spark.createDataFrame([], "x double, y int")
    stored = df.withColumn("y", F.col("y").cast("string")).schema.json()
    got = {r.column: r.status for r in checks.check_schema_artifact(df, stored).collect()}
    assert got == {"x": "same", "y": "changed"}
    for text in ("daily_schema", "{}", "[1]", "null"):
        assert checks.check_schema_artifact(df, text).first().status == "unreadable"
