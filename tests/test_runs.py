"""Versions, stored profiles, first splits and whole runs."""

import datetime as dt
import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from squall.functions import calendar_features
from squall.models.features import DAILY_FEATURES, DAILY_TARGETS, combinations
from squall.models.predictors import (
    CLIMATOLOGY,
    first_split,
    fit_climatology,
    predict_batch,
    prediction,
    train_models,
)
from squall.models.retrain import models_in_force, monitor_models, retrain_if_degraded
from squall.models.splits import best_split
from squall.operators import checks
from squall.operators.profiles import (
    compare_profiles,
    merge_profiles,
    partial_profile,
    profile_figures,
    share_below,
)
from squall.plans.collection import run_daily
from squall.plans.modelling import model_daily
from squall.sources.schemas import DAILY_REQUESTED, RESPONSE_SCHEMA
from squall.versions import Versions

TARGET = DAILY_TARGETS[0]


@pytest.fixture(scope="module")
def days(spark):
    rng = np.random.default_rng(4)
    rows = []
    for station in "ab":
        for i in range(730):
            day = dt.date(2021, 1, 1) + dt.timedelta(days=i)
            warm = 10 - 15 * np.cos(2 * np.pi * day.timetuple().tm_yday / 365)
            rows.append((station, day, float(warm + rng.normal() + 30 * (i >= 365))))
    df = spark.createDataFrame(rows, f"station string, date date, {TARGET} double")
    return df.withColumns(calendar_features(F.col("date"))).cache()


def test_a_half_written_version_is_not_in_force(spark, tmp_path):
    versions = Versions(spark, str(tmp_path))
    assert versions.current() is None

    def whole(path, n):
        spark.range(n).write.parquet(path)

    first = versions.publish(lambda path: whole(path, 3))

    def broken(path):
        whole(path, 5)
        raise OSError("no space left")

    with pytest.raises(OSError, match="space"):
        versions.publish(broken)
    assert versions.current() == first and spark.read.parquet(first.path).count() == 3
    second = versions.publish(lambda path: whole(path, 7))
    assert (first.number, second.number) == (1, 2)
    assert versions.current() == second and versions.history().count() == 2


def test_failed_retraining_leaves_the_old_models_in_force(spark, days, tmp_path):
    versions = Versions(spark, str(tmp_path))
    old = fit_climatology(days.filter("year(date) = 2021"), DAILY_TARGETS)
    versions.publish(old.save)
    strict = monitor_models(old, days, {"rmse": 0.1, "r2": 0.99}, "date", "2022-01-01")

    class Failing:
        def fit(self, df, features, targets):
            model = fit_climatology(df, targets)
            model.save = lambda path: (_ for _ in ()).throw(OSError("lost"))
            return model

    with pytest.raises(OSError, match="lost"):
        retrain_if_degraded(old, days, strict, DAILY_FEATURES, versions, Failing())
    held = models_in_force(versions, CLIMATOLOGY, DAILY_TARGETS, DAILY_FEATURES)
    first_day = days.filter("station = 'a' and date = '2021-01-01'")
    assert predict_batch(held, first_day).first()[prediction(TARGET)] == pytest.approx(
        predict_batch(old, first_day).first()[prediction(TARGET)]
    )
    new, fresh = retrain_if_degraded(old, days, strict, DAILY_FEATURES, versions, CLIMATOLOGY)
    assert fresh and versions.current().number == 2
    assert predict_batch(new, first_day).first()[prediction(TARGET)] > 10


def test_first_split_of_a_trained_stump(spark, days):
    stumps = train_models(days, DAILY_FEATURES, DAILY_TARGETS, trees=1, depth=1)
    (target, feature, threshold, left, right) = first_split(stumps)[0]
    best = best_split(combinations(days, DAILY_FEATURES, DAILY_TARGETS), DAILY_FEATURES, TARGET).first()
    assert (best.target, best.feature, best.threshold) == (target, feature, threshold)
    assert (best.left_mean, best.right_mean) == pytest.approx((left, right))
    sides = days.groupBy((F.col(feature) <= threshold).alias("left")).agg(F.avg(TARGET).alias("m"))
    assert {r.left: r.m for r in sides.collect()} == pytest.approx({True: left, False: right})
    one = combinations(days.limit(1), DAILY_FEATURES, DAILY_TARGETS)
    assert best_split(one, DAILY_FEATURES, TARGET).count() == 0


def test_more_feature_values_than_the_usual_bins(spark):
    rows = spark.range(1500).select(F.col("id").cast("int").alias("minute"), (F.col("id") >= 1234).cast("double").alias("y"))
    model = train_models(rows, ["minute"], ["y"], trees=1, depth=1)
    assert first_split(model)[0][2] == 1233.5


def test_merged_profiles_equal_the_whole(spark):
    rng = np.random.default_rng(9)
    data = [
        (k % 5, float(rng.normal(1e6, 3)), None if k % 7 else float(rng.exponential()), None, k) for k in range(4000)
    ]
    df = spark.createDataFrame(data, "part int, a double, b double, blank double, n long")
    cols = ["a", "b", "blank", "n"]
    parts = [partial_profile(df.filter(F.col("part") == p), cols) for p in range(5)]
    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p)
    empty = partial_profile(df.limit(0), cols)
    merged = merge_profiles(union.unionByName(empty))
    got = {r.column: r for r in profile_figures(merged).collect()}
    want = {r.column: r for r in profile_figures(partial_profile(df, cols)).collect()}
    pdf = df.toPandas()
    for c in cols:
        g, w, x = got[c], want[c], pdf[c].dropna().astype(float)
        same = ("rows", "count", "nulls", "min", "max", "type")
        assert [g[f] for f in same] == [w[f] for f in same]
        assert g["count"] == len(x) and g.nulls == len(pdf) - len(x)
        if len(x):
            assert (g.mean, g.std) == pytest.approx((x.mean(), x.std()), rel=1e-9)
            for p, name in ((0.25, "q1"), (0.5, "median"), (0.75, "q3")):
                assert abs((x <= g[name]).mean() - p) < 0.02
        else:
            assert g.mean is None and g.std is None and g.median is None
    shares = {r.column: r.share for r in share_below(merged, {"n": 1000, "blank": 1}).collect()}
    assert set(shares) == {"n"} and abs(shares["n"] - 0.25) < 0.02


def test_profiles_compared_between_runs(spark):
    old = spark.createDataFrame([(1.0, 1, "x"), (3.0, 2, "y")], "a double, b int, c string")
    new = spark.createDataFrame([(5.0, 1), (None, 2), (7.0, 4)], "a double, d int")
    got = {
        r.column: r
        for r in compare_profiles(partial_profile(old, ["a", "b"]), partial_profile(new, ["a", "d"])).collect()
    }
    assert {c: r.status for c, r in got.items()} == {"a": "same", "b": "missing", "d": "extra"}
    a = got["a"]
    assert a.null_change == pytest.approx(1 / 3) and a.mean_shift == pytest.approx(4 / np.std([1, 3], ddof=1))
    assert (a.below, a.above) == (0.0, 4.0) and got["b"].above is None
    changed = compare_profiles(partial_profile(old, ["b"]), partial_profile(old.withColumn("b", F.lit(1.5)), ["b"]))
    assert changed.first().status == "changed"


def test_checks_counted_while_writing(spark, tmp_path):
    df = spark.createDataFrame([(1.0, None), (-2.0, 3.0), (None, 1.0)], "precipitation_sum double, y double").repartition(3)
    found = checks.write_checked(df, f"{tmp_path}/t", checks.suite(df))
    assert found == {"rows": 3, "no_nulls": 2, "precipitation_sum_non_negative": 2}
    table = checks.checks_table(spark, "daily", found).collect()
    assert {(r.check, r.violations, r.rows, r.passed) for r in table} == {
        ("no_nulls", 2, 3, False), ("precipitation_sum_non_negative", 2, 3, False),
    }
    counted = {r.check: r.violations for r in checks.validate_suite(df, "daily").collect()}
    assert counted == {c: n for c, n in found.items() if c != "rows"}
    assert checks.write_checked(df.limit(0), f"{tmp_path}/e", checks.suite(df))["rows"] == 0


def test_daily_run_from_answers_to_schema_check(spark, tmp_path):
    rng = np.random.default_rng(2)
    n = 60
    values = {v: [float(x) for x in rng.normal(10, 3, n)] for v in DAILY_REQUESTED}
    start = dt.datetime(2023, 3, 1)
    rows = [(s, start, start + dt.timedelta(days=n), 86_400, values) for s in "ab"]
    answers = spark.createDataFrame(rows, RESPONSE_SCHEMA)
    first = run_daily(answers, f"{tmp_path}/1")
    manifest = {r.artifact: r for r in first.manifest.collect()}
    assert manifest["raw"].rows == manifest["engineered"].rows == 2 * n
    assert manifest["schema_check"].passed and not manifest["validation"].passed
    for name, row in manifest.items():
        assert first.table(name).count() == row.rows
    fields = json.loads(first.table("schema").first().schema)["fields"]
    assert [f["name"] for f in fields] == first.table("engineered").columns
    second = run_daily(answers, f"{tmp_path}/2", previous=f"{tmp_path}/1")
    drift = second.table("profile_check").collect()
    assert all(r.status == "same" and not r.mean_shift for r in drift)
    assert {r.artifact for r in second.manifest.collect()} - set(manifest) == {"profile_check"}


def test_model_run_retrains_on_newer_rows(spark, days, tmp_path):
    raw = days.select("station", "date", TARGET)
    done = model_daily(
        raw, str(tmp_path), "2023-01-01", ["station", "date"], ["station"], since="2022-01-01", family=CLIMATOLOGY
    )
    assert done.retrained and done.version == 2
    assert done.monitored.first().n == 730 and done.bias.first().n == 1460
    assert done.today.count() == 2 and done.today.agg(F.max(TARGET)).first()[0] < 10
    assert {r.artifact: r.rows for r in done.manifest.collect()} == {
        t: done.tables[t].count() for t in ("bias", "chart", "sensitivity", "holdout", "today", "monitored")
    }
    assert (tmp_path / "runs/1/sensitivity-by-target" / f"target={TARGET}").is_dir()
    with pytest.raises(AttributeError):
        done.weather
    again = model_daily(
        raw, str(tmp_path), "2023-01-01", ["station", "date"], ["station"], {"rmse": 99.0, "r2": -9.0}, family=CLIMATOLOGY
    )
    assert not again.retrained and again.version == 3
