import datetime as dt
import math
import sys

import numpy as np
import pandas as pd
import pytest
from frames import close, column, series
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from squall.operators import columns
from squall.operators.eda import boxplot, correlation_matrix, histogram, kde, profile, scatter_cells
from squall.operators.flags import quantile_flags
from squall.operators.metrics import error_metrics, monitor, retrain_needed
from squall.operators.quantiles import quantiles
from squall.operators.scaling import (
    clip_and_scale,
    iqr_bounds,
    iqr_clip,
    minmax_fit,
    minmax_inverse,
    minmax_scale,
)


def frame(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x double")


def by_index(df, name="x"):
    return column(df, name, "i")


def test_quantile_paths_agree_with_numpy(spark):
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(size=3000), rng.pareto(0.5, 500), np.repeat(1.25, 700)])
    df = spark.createDataFrame(pd.DataFrame({"k": rng.integers(0, 3, x.size), "x": x}))
    probs = [0.0, 0.1, 0.25, 0.5, 0.95, 1.0]
    want = {
        (k, p): np.quantile(x, p)
        for k, x in df.toPandas().groupby("k").x
        for p in probs
    }
    for options in ({}, {"max_values_in_task": 0}, {"max_values_in_task": 0, "bins": 3}):
        got = {(r.k, r.p): r.value for r in quantiles(df, ["x"], probs, ["k"], **options).collect()}
        assert got.keys() == want.keys()
        for key, value in want.items():
            assert got[key] == pytest.approx(value, rel=1e-12), (options, key)


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(-1e6, 1e6) | st.none(), min_size=1, max_size=60))
def test_bracketed_quantiles_of_anything(spark, values):
    df = frame(spark, values)
    got = quantiles(df, ["x"], [0.25, 0.9], max_values_in_task=0, bins=4).collect()
    known = [v for v in values if v is not None]
    want = np.quantile(known, [0.25, 0.9]) if known else [None, None]
    for row, w in zip(sorted(got, key=lambda r: r.p), want):
        assert row.value is None if w is None else row.value == pytest.approx(w, abs=1e-6)


@pytest.mark.parametrize(
    "values",
    [
        [1.0, 2.0, 3.0, math.inf],
        [-math.inf, -1.0, 4.0, 4.0, math.inf, math.inf],
        [-1.5e308, -1e308, 0.0, 1.0, 1.5e308],
        [-math.inf, -sys.float_info.max, sys.float_info.max],
        [0.0, 5e-324, 1e-323],
        [7.0] * 5,
        [-math.inf] * 3,
    ],
)
def test_quantile_paths_agree_on_extreme_values_and_empty_keys(spark, values):
    rows = [("a", v) for v in values] + [("b", None), ("b", None)]
    df = spark.createDataFrame(rows, "k string, x double")
    probs = [0.0, 0.3, 0.5, 1.0]
    small, large = (
        {(r.k, r.p): r.value for r in quantiles(df, ["x"], probs, ["k"], **options).collect()}
        for options in ({}, {"max_values_in_task": 0, "bins": 4})
    )
    assert small.keys() == large.keys() and len(small) == 2 * len(probs)
    for key, value in small.items():
        assert large[key] == (value if value is None else pytest.approx(value, rel=1e-12, nan_ok=True)), key
    bounds = [iqr_bounds(df, ["x"], ["k"], **o).count() for o in ({}, {"max_values_in_task": 0})]
    assert bounds == [2, 2]


def test_approximate_quantiles(spark):
    df = frame(spark, [float(i) for i in range(1001)])
    got = quantiles(df, ["x"], [0.5], method="approx").first().value
    assert abs(got - 500) <= 1


def test_clip_keeps_rows_and_nulls(spark):
    values = [1.0, 2.0, 3.0, 4.0, 5.0, 100.0, None, -90.0]
    got = by_index(iqr_clip(frame(spark, values), ["x"]))
    s = pd.Series(values)
    q1, q3 = s.quantile(0.25), s.quantile(0.75)
    assert close(got, s.clip(q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)))


def test_scale_rounds_half_to_even_and_constant_is_null(spark):
    values = [0.0, 0.0005, 0.0015, 0.0025, 1.0, None]
    assert by_index(minmax_scale(frame(spark, values), ["x"])) == [0.0, 0.0, 0.002, 0.002, 1.0, None]
    assert by_index(minmax_scale(frame(spark, [3.0, 3.0]), ["x"])) == [None, None]
    assert by_index(minmax_scale(frame(spark, []), ["x"])) == []


@pytest.mark.parametrize("keys", [[], ["station"]])
def test_clip_and_scale_is_clip_then_scale(spark, keys):
    rng = np.random.default_rng(5)
    df = series(spark, [float(v) for v in rng.pareto(1, 300)])
    both, scaler = clip_and_scale(df, ["x"], keys)
    steps = minmax_scale(iqr_clip(df, ["x"], keys), ["x"], keys)
    assert column(both) == column(steps)
    unit = scaler.first()
    clipped = column(iqr_clip(df, ["x"], keys))
    assert (unit["min"], unit["max"]) == (min(clipped), max(clipped))


def test_scaler_round_trip(spark):
    df = spark.createDataFrame([(10.0,), (20.0,), (30.0,)], "apparent_temperature_max double")
    cols = ["apparent_temperature_max"]
    scaler = minmax_fit(df, [*cols, "rain"])
    assert [tuple(r) for r in scaler.collect()] == [("apparent_temperature_max", 10.0, 30.0)]
    back = minmax_inverse(minmax_scale(df, cols, scaler=scaler), scaler, cols)
    assert sorted(r[0] for r in back.collect()) == [10.0, 20.0, 30.0]


def test_inverse_of_half(spark):
    scaler = spark.createDataFrame([("x", 10.0, 20.0)], "column string, min double, max double")
    assert by_index(minmax_inverse(frame(spark, [0.5]), scaler, ["x"])) == [15.0]


def test_nan_becomes_null_and_empty_columns_go(spark):
    df = spark.createDataFrame([(float("nan"), None, 1.0)], "a double, b double, c double")
    clean = columns.nan_to_null(df)
    assert clean.first().a is None
    assert columns.drop_all_null_columns(clean).columns == ["c"]


def test_drop_columns_is_strict(spark):
    df = frame(spark, [1.0])
    with pytest.raises(ValueError, match="nothing"):
        columns.drop_columns(df, ["nothing"])
    assert columns.drop_columns(df, ["x", "nothing"], strict=False).columns == ["i"]


def test_categories_are_not_numeric(spark):
    df = columns.as_category(frame(spark, [1.0]), ["x"])
    assert columns.is_category(df, "x")
    assert columns.numeric_columns(df) == ["i"]
    scaled = minmax_scale(df, ["i"])
    assert columns.is_category(scaled, "x")


def test_quantile_flags(spark):
    rng = np.random.default_rng(1)
    data = pd.DataFrame(
        {
            "temperature_2m_max": rng.normal(20, 5, 50),
            "temperature_2m_min": rng.normal(5, 5, 50),
            "precipitation_sum": rng.exponential(2, 50),
        }
    )
    got = quantile_flags(spark.createDataFrame(data)).toPandas()
    hot = data.temperature_2m_max > data.temperature_2m_max.quantile(0.9)
    assert got.is_hot_day.sum() == hot.sum() == 5
    assert got.is_cold_day.sum() == 5
    assert got.is_heavy_precipitation.sum() == 3


def test_correlation_matches_pandas(spark):
    rng = np.random.default_rng(2)
    data = pd.DataFrame(rng.normal(size=(200, 3)), columns=list("abc"))
    data.loc[rng.random(200) < 0.2, "b"] = np.nan
    data["k"] = 4.0
    df = columns.nan_to_null(spark.createDataFrame(data))
    want = data.corr()
    for r in correlation_matrix(df, list("abck")).collect():
        w = want.loc[r.col_a, r.col_b]
        assert r["corr"] is None if np.isnan(w) else r["corr"] == pytest.approx(w, abs=1e-12)


def test_histogram_bins(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=500)
    got = histogram(frame(spark, [float(v) for v in x]), "x").orderBy("bin").collect()
    iqr = np.subtract(*np.quantile(x, [0.75, 0.25]))
    width = min(2 * iqr / 500 ** (1 / 3), np.ptp(x) / (np.log2(500) + 1))
    counts, edges = np.histogram(x, int(np.ceil(np.ptp(x) / width)))
    assert [r["count"] for r in got] == list(counts)
    assert [r.left for r in got] == pytest.approx(list(edges[:-1]))
    constant = histogram(frame(spark, [2.0, 2.0]), "x").collect()
    assert [(r.left, r.right, r["count"]) for r in constant] == [(1.5, 2.5, 2)]
    assert histogram(frame(spark, [None]), "x").collect() == []


def test_density(spark):
    rng = np.random.default_rng(6)
    x = np.round(rng.normal(size=300), 1)
    df = frame(spark, [float(v) for v in x])
    got = kde(df, "x").orderBy("point").collect()
    h = x.std(ddof=1) * 300**-0.2
    grid = np.linspace(x.min(), x.max(), 200)
    want = [np.exp(-(((g - x) / h) ** 2) / 2).sum() / (300 * h * np.sqrt(2 * np.pi)) for g in grid]
    assert [r.density for r in got] == pytest.approx(want)
    rough = kde(df, "x", cells=4096).orderBy("point").collect()
    assert [r.density for r in rough] == pytest.approx(want, rel=1e-2)
    assert kde(frame(spark, [1.0, 1.0]), "x").collect() == []


def test_boxplot(spark):
    rows = [("w", float(v)) for v in [1, 2, 3, 4, 100]] + [("s", 7.0), ("s", None), (None, 1.0)]
    df = spark.createDataFrame(rows, "season string, p double")
    got = {r.season: r.asDict() for r in boxplot(df, "season", "p").collect()}
    assert got["w"] == {
        "season": "w", "n": 5, "whisker_low": 1.0, "q1": 2.0, "median": 3.0, "q3": 4.0,
        "whisker_high": 4.0, "outliers": 1,
    }
    assert got["s"]["whisker_low"] == got["s"]["whisker_high"] == 7.0
    assert set(got) == {"w", "s"}


def test_profile(spark):
    got = profile(frame(spark, [1.0, 2.0, 3.0, None]), ["x", "i"]).collect()
    assert [tuple(r) for r in got] == [
        ("x", "double", 3, 1, 2.0, 1.0, 1.0, 1.5, 2.0, 2.5, 3.0),
        ("i", "int", 4, 0, 1.5, pytest.approx(1.2909944487), 0.0, 0.75, 1.5, 2.25, 3.0),
    ]


def test_scatter_counts_every_pair(spark):
    df = spark.createDataFrame([(float(i % 7), float(i % 5)) for i in range(700)], "y double, p double")
    cells = scatter_cells(df, "y", "p", 10)
    assert cells.agg(F.sum("n")).first()[0] == 700
    assert cells.agg(F.max("actual_bin")).first()[0] == 9


def metrics_of(spark, pairs):
    df = spark.createDataFrame(pairs, "y double, p double")
    return error_metrics(df, {"t": ("y", "p")})


def test_error_metrics(spark):
    m = metrics_of(spark, [(1.0, 2.0), (2.0, 2.0), (4.0, 3.0), (None, 1.0), (1.0, None)]).first()
    assert (m.n, m.mae, m.bias) == (3, pytest.approx(2 / 3), 0.0)
    assert m.rmse == pytest.approx(np.sqrt(2 / 3))
    assert m.r2 == pytest.approx(1 - 2 / 4.666666666)


@pytest.mark.parametrize(
    "pairs, r2",
    [([(1.0, 1.0), (2.0, 2.0)], 1.0), ([(3.0, 3.0), (3.0, 3.0)], 1.0), ([(3.0, 2.0), (3.0, 3.0)], 0.0)],
)
def test_r2_of_perfect_and_constant(spark, pairs, r2):
    assert metrics_of(spark, pairs).first().r2 == r2


def test_gate(spark):
    good = monitor(metrics_of(spark, [(1.0, 1.0), (2.0, 2.0)]), {"rmse": 5.0, "r2": 0.8})
    bad = monitor(metrics_of(spark, [(1.0, 2.0), (2.0, 1.0)]), {"rmse": 5.0, "r2": 0.8})
    assert not retrain_needed(good) and not good.first().retrain_needed
    assert retrain_needed(bad) and bad.first().breach


def test_horizon_and_selection(spark):
    days = [(dt.date(2024, 1, d),) for d in range(1, 12)]
    df = spark.createDataFrame(days, "date date")
    assert columns.within_horizon(df, "date", "2024-01-02").count() == 8
    marked = columns.mark_selected(df, "date", "2024-01-05").filter("Selected").collect()
    assert [r.date for r in marked] == [dt.date(2024, 1, 5)]


def test_scaler_of_a_caller_is_written_before_the_join(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 2.0), ("b", 6.0)], "station string, x double")
    scaler = minmax_fit(df, ["x"], ["station"])
    back = minmax_inverse(minmax_scale(df, ["x"], ["station"], scaler), scaler, ["x"], ["station"])
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") == 2
    assert sorted(map(tuple, back.collect())) == [("a", 1.0), ("a", 3.0), ("b", 2.0), ("b", 6.0)]
