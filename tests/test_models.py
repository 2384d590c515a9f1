import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from squall.functions import calendar_features
from squall.models import predictors
from squall.models.analysis import evaluate, sensitivity_analysis
from squall.models.features import (
    DAILY_FEATURES,
    HOURLY_FEATURES,
    combinations,
    train_test_split,
)
from squall.models.forecast import (
    daily_calendar,
    forecast_daily,
    forecast_digest,
    forecast_hourly,
    predict_single_date,
)
from squall.models.predictors import (
    fit_climatology,
    load_models,
    predict_batch,
    prediction,
    train_models,
)
from squall.models.retrain import monitor_models, retrain_if_degraded
from squall.operators.metrics import DAILY_THRESHOLDS
from squall.plans.modelling import model_daily
from suite import QUERIES

TARGET = "apparent_temperature_max"


@pytest.fixture(scope="module")
def days(spark):
    """Three stations, three years, a yearly cycle with noise."""
    rng = np.random.default_rng(11)
    rows = []
    for station in "abc":
        for i in range(1095):
            day = dt.date(2021, 1, 1) + dt.timedelta(days=i)
            season = 10 - 15 * np.cos(2 * np.pi * day.timetuple().tm_yday / 365)
            rows.append((station, day, float(season + rng.normal())))
    df = spark.createDataFrame(rows, f"station string, date date, {TARGET} double")
    return df.withColumns(calendar_features(F.col("date"))).cache()


@pytest.fixture(scope="module")
def stations(spark):
    return spark.createDataFrame([("a",), ("b",)], "station string")


@pytest.fixture(scope="module")
def trees(days):
    return train_models(days, DAILY_FEATURES, [TARGET], trees=8)


def test_split_is_stable_and_near_a_fifth(days):
    train, test = train_test_split(days, ["station", "date"])
    again = train_test_split(days.repartition(13), ["station", "date"])[1]
    assert sorted(test.select("station", "date").collect()) == sorted(
        again.select("station", "date").collect()
    )
    assert train.count() + test.count() == days.count()
    assert 0.15 < test.count() / days.count() < 0.25
    other = train_test_split(days, ["station", "date"], seed=7)[1]
    assert other.exceptAll(test).count() > 0


def test_training_set_does_not_grow_with_rows(days):
    once = combinations(days, DAILY_FEATURES, [TARGET])
    twice = combinations(days.unionByName(days), DAILY_FEATURES, [TARGET])
    assert once.count() == twice.count() <= 3 * 366
    assert twice.agg(F.sum("rows")).first()[0] == 2 * days.count()


def test_weighted_combinations_train_the_same_model(spark, days):
    """One row per combination and weight, or every row on its own: the same predictions."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import DecisionTreeRegressor

    def fitted(rows, label, weight=None):
        assembler = VectorAssembler(inputCols=list(DAILY_FEATURES), outputCol="features")
        tree = DecisionTreeRegressor(labelCol=label, maxDepth=4, maxBins=400, seed=1)
        tree = tree.setWeightCol(weight) if weight else tree
        model = Pipeline(stages=[assembler, tree]).fit(rows)
        scored = model.transform(days).orderBy("station", "date").select("prediction")
        return [r[0] for r in scored.collect()]

    combos = combinations(days, DAILY_FEATURES, [TARGET])
    by_row = fitted(days, TARGET)
    by_combo = fitted(combos, f"{TARGET}__mean", f"{TARGET}__n")
    assert by_combo == pytest.approx(by_row, abs=1e-6)


def test_trees_beat_the_mean(trees, days):
    m = evaluate(trees, days).first()
    assert m.n == days.count() and m.r2 > 0.8 and abs(m.bias) < 0.2


def test_save_and_load(trees, days, tmp_path):
    trees.save(str(tmp_path))
    assert (tmp_path / TARGET).is_dir()
    again = load_models(str(tmp_path), [TARGET], DAILY_FEATURES)
    rows = days.limit(50)
    before = [r[0] for r in trees.score(rows).select(prediction(TARGET)).collect()]
    assert before == [r[0] for r in again.score(rows).select(prediction(TARGET)).collect()]


def test_batch_equals_row_by_row(trees, days):
    batch = predict_batch(trees, days).orderBy("station", "date").select(prediction(TARGET))
    rows = trees.score(days).orderBy("station", "date").select(prediction(TARGET))
    assert batch.collect() == rows.collect()


def test_sensitivity_is_the_mean_of_the_changed_rows(trees, days):
    got = sensitivity_analysis(trees, days, DAILY_FEATURES, {"month": (1, 12), "day_of_year": (182,)})
    values = {(r.feature, r.value): r.average_prediction for r in got.collect()}
    assert len(values) == 3
    for (feature, value), mean in values.items():
        changed = trees.score(days.withColumn(feature, F.lit(value)))
        assert mean == pytest.approx(changed.agg(F.avg(prediction(TARGET))).first()[0])


def test_climatology_is_the_group_mean(days):
    model = fit_climatology(days, [TARGET])
    got = predict_batch(model, days).groupBy("month", "is_weekend").agg(
        F.avg(TARGET).alias("y"), F.max(prediction(TARGET)).alias("p")
    )
    assert all(r.y == pytest.approx(r.p) for r in got.collect())
    july = fit_climatology(days.filter("month = 7"), [TARGET])
    mean = days.filter("month = 7").agg(F.avg(TARGET)).first()[0]
    unseen = july.score(days.filter("month = 1")).first()[prediction(TARGET)]
    assert unseen == pytest.approx(mean)


def test_daily_forecast(spark, days, stations):
    model = fit_climatology(days, [TARGET])
    scaler = spark.createDataFrame(
        [("a", TARGET, 0.0, 1.0), ("b", TARGET, 10.0, 30.0)],
        "station string, column string, min double, max double",
    )
    plain = forecast_daily(model, stations, "2024-12-28").filter("station = 'a'")
    rows = forecast_daily(model, stations, "2024-12-28", scaler, ["station"])
    assert rows.count() == 14
    a, b = (
        [r[TARGET] for r in rows.filter(F.col("station") == s).orderBy("date").collect()]
        for s in "ab"
    )
    assert a == [r[TARGET] for r in plain.orderBy("date").collect()]
    assert b == pytest.approx([v * 20 + 10 for v in a])
    assert [r.week_of_year for r in rows.filter("station = 'a'").orderBy("date").collect()] == [
        52, 52, 1, 1, 1, 1, 1,
    ]


def test_hourly_forecast_and_single_date(days, stations):
    model = fit_climatology(days, [TARGET])
    rows = forecast_hourly(model, stations, ["2024-07-06"])
    assert rows.count() == 48
    assert sorted({r.hour for r in rows.collect()}) == list(range(24))
    assert set(HOURLY_FEATURES) < set(rows.columns)
    one = predict_single_date(model, stations, "2024-07-06").collect()
    assert [r.date for r in one] == [dt.date(2024, 7, 6)] * 2


def test_calendar_length(stations):
    assert daily_calendar(stations, "2024-02-27").groupBy("station").count().first()[1] == 7


def test_digest(spark):
    rows = [("a", dt.date(2024, 1, 1 + i), 30.0 + i) for i in range(7)]
    df = spark.createDataFrame(rows, f"station string, date date, {TARGET} double").repartition(4)
    lines = forecast_digest(df, "date", TARGET, ["station"], digits=1).first().digest.split("\n")
    table = pd.DataFrame({"date": [r[1] for r in rows], TARGET: [r[2] for r in rows]})
    assert lines == table.to_string(index=False).split("\n")


def test_monitor_and_retrain(trees, days, tmp_path):
    fine = monitor_models(trees, days, {"rmse": 5.0, "r2": 0.5})
    kept, fresh = retrain_if_degraded(trees, days, fine, DAILY_FEATURES, str(tmp_path / "x"))
    assert kept is trees and not fresh and not (tmp_path / "x").exists()
    strict = monitor_models(trees, days, {"rmse": 0.1, "r2": 0.5}, "date", "2023-01-01")
    assert strict.first().n == 3 * 365
    new, fresh = retrain_if_degraded(
        trees, days, strict, DAILY_FEATURES, str(tmp_path / "y"), trees=2
    )
    assert fresh and new is not trees and (tmp_path / "y" / TARGET).is_dir()


def test_daily_plan(days, tmp_path):
    raw = days.select("station", "date", TARGET)
    done = model_daily(
        raw, str(tmp_path), "2024-01-01", ["station", "date"], ["station"], DAILY_THRESHOLDS, trees=3
    )
    assert done.holdout.first().n + train_test_split(days, ["station", "date"])[0].count() == 3285
    assert done.sensitivity.count() == 9 and done.today.count() == 3
    assert done.retrained == done.monitored.first().retrain_needed


@pytest.mark.parametrize("name", [
    "train_models", "model_save_load", "holdout_evaluation", "predict_batch", "sensitivity_analysis",
    "sensitivity_analysis_daily", "bias_analysis", "predict_single_date", "forecast_daily",
    "forecast_hourly", "retrain_if_degraded", "daily_modelling", "hourly_modelling",
])
def test_query_trains_whole_models_itself(spark, sf_dir, monkeypatch, name):
    asked, fit = [], predictors._fit

    def small(combos, features, target, trees, *rest):
        asked.append(trees)
        return fit(combos, features, target, 1, *rest)

    monkeypatch.setattr(predictors, "_fit", small)
    assert QUERIES[name](spark, sf_dir).columns
    assert asked and set(asked) == {100}
