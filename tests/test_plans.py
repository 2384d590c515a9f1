import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from squall.operators.columns import is_category
from squall.plans.collection import collect_daily
from squall.plans.daily import daily_features
from squall.plans.daily import preprocess as preprocess_daily
from squall.plans.hourly import engineer as engineer_hourly
from squall.plans.hourly import hourly_features
from squall.plans.hourly import preprocess as preprocess_hourly
from squall.sources.schemas import DAILY_VARIABLES, HOURLY_VARIABLES
from squall.streaming import read_stream, row_features, write_available


@pytest.fixture(scope="module")
def daily_raw(spark):
    rng = np.random.default_rng(21)
    n = 400
    data = pd.DataFrame({v: rng.normal(10, 4, n).round(2) for v in DAILY_VARIABLES})
    data["precipitation_sum"] = np.where(rng.random(n) < 0.5, 0.0, rng.exponential(3, n).round(1))
    data["precipitation_hours"] = np.where(data.precipitation_sum > 0, 3.0, 0.0)
    data.loc[rng.random(n) < 0.1, "temperature_2m_max"] = np.nan
    data.insert(0, "date", pd.date_range("2023-05-01", periods=n).date)
    return data, spark.createDataFrame(data).repartition(3)


def test_daily_preprocess_against_pandas(daily_raw):
    data, df = daily_raw
    rows, scaler = preprocess_daily(df)
    got = rows.toPandas().sort_values("date").reset_index(drop=True)
    for c in ("temperature_2m_max", "daylight_duration", "precipitation_sum"):
        x = data[c].ffill() if c != "daylight_duration" else data[c]
        q1, q3 = x.quantile(0.25), x.quantile(0.75)
        x = x.clip(q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1))
        want = ((x - x.min()) / (x.max() - x.min())).round(3)
        assert np.allclose(got[c], want, equal_nan=True), c
    assert {"uv_index_max", "sunrise"}.isdisjoint(got.columns)
    assert got.season.iloc[0] == "Spring" and set(got.is_weekend) == {0.0, 1.0}
    assert is_category(rows, "weather_code") and is_category(rows, "is_weekend")
    assert "temperature_2m_max" in {r.column for r in scaler.collect()}


def test_daily_scale_orders(daily_raw):
    _, df = daily_raw
    frames = {s: daily_features(df, scale=s)[0].toPandas() for s in ("before", "after", "none")}
    assert frames["before"].temperature_range.max() <= 1 < frames["after"].temperature_range.max()
    assert frames["after"].temperature_2m_max.max() == 1.0 < frames["none"].temperature_2m_max.max()
    assert sorted(frames["none"].temperature_range) == sorted(frames["after"].temperature_range)
    assert list(frames["after"].sort_values("date").season[:62].unique()) == [0, 1]
    assert (frames["after"].temperature_range == frames["after"].diurnal_temp_range).all()
    with pytest.raises(ValueError, match="scale order"):
        daily_features(df, scale="sometimes")


def test_collected_daily_tables(daily_raw):
    _, df = daily_raw
    collected = collect_daily(df, scale="before")
    assert collected.schema_check(collected.schema).filter("status <> 'same'").count() == 0
    assert collected.validation.filter("check = 'no_nulls'").first().violations > 0
    assert collected.temperature_density.count() == 200
    assert collected.precipitation_by_season.count() == 4
    assert collected.profile.count() == len(collected.numbers)
    assert collected.correlation.count() == len(collected.numbers) ** 2


@pytest.fixture(scope="module")
def hourly_raw(spark):
    rng = np.random.default_rng(8)
    n = 200
    data = pd.DataFrame(
        {
            "datetime": pd.date_range("2024-12-20", periods=n, freq="h"),
            "temperature_2m": rng.uniform(-5, 15, n),
            "relative_humidity_2m": rng.uniform(30, 80, n),
            "dew_point_2m": rng.uniform(-10, 10, n),
            "precipitation": rng.uniform(0, 10, n),
            "rain": rng.uniform(0, 10, n),
            "showers": 0.0,
            "snowfall": rng.uniform(0, 5, n),
            "weather_code": rng.integers(0, 4, n).astype(float),
            "wind_speed_10m": rng.uniform(0, 20, n),
            "visibility": np.nan,
        }
    )
    data.loc[[0, 50, 51, 199], "temperature_2m"] = np.nan
    data.loc[[3, 60], "wind_speed_10m"] = np.nan
    return data, spark.createDataFrame(data)


def test_hourly_scaling_drops_constant_columns(hourly_raw):
    _, df = hourly_raw
    df = df.limit(40).withColumn("snowfall", F.lit(0.0))
    kept, _ = preprocess_hourly(df, scale=False)
    scaled, _ = preprocess_hourly(df)
    assert set(kept.columns) - set(scaled.columns) == {"showers", "snowfall"}
    engineered, _ = hourly_features(df, scale="before")
    assert "snowfall" not in engineered.columns and engineered.count() == 40


def test_hourly_features_against_pandas(hourly_raw):
    data, df = hourly_raw
    got = hourly_features(df, scale="none")[0].toPandas().sort_values("datetime", ignore_index=True)
    t = data.set_index("datetime").temperature_2m.interpolate(method="time").reset_index(drop=True)
    wind = data.wind_speed_10m.fillna(data.wind_speed_10m.mean())
    assert "visibility" not in got.columns
    assert np.allclose(got.temperature_2m, t, equal_nan=True)
    assert np.allclose(got.temp_rolling_mean_24h, t.rolling(24).mean(), equal_nan=True)
    assert np.allclose(got.precip_rolling_sum_24h, data.precipitation.rolling(24).sum(), equal_nan=True)
    assert np.allclose(got.wind_speed_10m, wind)
    assert set(got.wind_category[(wind > 0) & (wind <= 2)]) <= {"Calm"}
    assert set(got.wind_category[wind > 11]) == {"Strong"}
    christmas = got.datetime.dt.date == dt.date(2024, 12, 25)
    assert (got.is_holiday[christmas] == 1).all()
    assert set(got.season) == {0}
    assert (got.is_freezing == (t <= 0)).all()


def test_fahrenheit_formulas_convert(spark, hourly_raw):
    data, _ = hourly_raw
    data = data.dropna(subset=["temperature_2m", "wind_speed_10m"]).assign(season="Fall", is_weekend=0)
    celsius = spark.createDataFrame(data.drop(columns="visibility"))
    hot = data.assign(
        temperature_2m=data.temperature_2m * 9 / 5 + 32, dew_point_2m=data.dew_point_2m * 9 / 5 + 32
    )
    fahrenheit = spark.createDataFrame(hot.drop(columns="visibility"))
    a = engineer_hourly(celsius).toPandas().sort_values("datetime")
    b = engineer_hourly(fahrenheit, fahrenheit=True).toPandas().sort_values("datetime")
    for c in ("is_freezing", "wind_chill", "heat_index", "dew_point_depression"):
        assert np.allclose(a[c], b[c]), c


def test_stream_equals_batch(spark, hourly_raw, tmp_path):
    _, df = hourly_raw
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    df.repartition(4).write.parquet(source)
    stream = row_features(read_stream(spark, source, df.schema))
    write_available(stream, out, str(tmp_path / "state"))
    df.limit(1).write.mode("append").parquet(source)
    write_available(stream, out, str(tmp_path / "state"))
    got, want = spark.read.parquet(out), row_features(df.unionByName(df.limit(1)))
    assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0


def test_daily_rows_of_equal_times_are_ordered_by_ties(spark):
    """Two readings a day: each gap takes the reading before it by day and number, however rows are dealt."""
    rng = np.random.default_rng(5)
    n = 120
    data = pd.DataFrame({v: rng.normal(10, 4, n).round(2) for v in DAILY_VARIABLES})
    data.loc[rng.random(n) < 0.4, "temperature_2m_max"] = np.nan
    data.insert(0, "date", np.repeat(pd.date_range("2023-05-01", periods=n // 2), 2).date)
    data.insert(1, "reading", np.tile([1, 2], n // 2))
    want = data.temperature_2m_max.ffill()
    q1, q3 = want.quantile(0.25), want.quantile(0.75)
    want = want.clip(q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1))
    scaled = ((want - want.min()) / (want.max() - want.min())).round(3)
    for seed, scale in ((1, "after"), (2, "before")):
        df = spark.createDataFrame(data.sample(frac=1, random_state=seed)).repartition(3)
        got = daily_features(df, ties=["reading"], scale=scale)[0].toPandas()
        got = got.sort_values(["date", "reading"])
        assert got.reading.tolist() == data.reading.tolist()
        assert np.allclose(got.temperature_2m_max, scaled, equal_nan=True, atol=0.0011)


def test_hourly_rolling_figures_of_equal_times_follow_ties(spark):
    n = 60
    data = pd.DataFrame({v: np.arange(n) % 7 + 0.5 for v in HOURLY_VARIABLES})
    data["temperature_2m"] = np.random.default_rng(6).normal(10, 4, n).round(2)
    data.insert(0, "datetime", np.repeat(pd.date_range("2024-01-01", periods=n // 2, freq="h"), 2))
    data.insert(1, "reading", np.tile([1, 2], n // 2))
    want = data.temperature_2m.rolling(24).mean()
    for seed in (1, 2):
        df = spark.createDataFrame(data.sample(frac=1, random_state=seed)).repartition(3)
        got = hourly_features(df, ties=["reading"], scale="none")[0].toPandas()
        got = got.sort_values(["datetime", "reading"])
        assert got.reading.tolist() == data.reading.tolist()
        assert np.allclose(got.temp_rolling_mean_24h[23:], want[23:], equal_nan=True)
