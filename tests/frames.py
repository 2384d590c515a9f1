"""Small series for the unit tests."""

import datetime as dt

import numpy as np
import pandas as pd

START = dt.datetime(2024, 1, 1)


def series(spark, values, station="a", step=dt.timedelta(hours=1), start=START):
    rows = [(station, start + i * step, v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "station string, datetime timestamp, x double")


def gappy(n=1000, seed=7, share=0.4):
    """Random walk with random nulls, a long gap and nulls at both ends."""
    rng = np.random.default_rng(seed)
    values = pd.Series(np.round(np.cumsum(rng.normal(size=n)), 3))
    values[rng.random(n) < share] = np.nan
    values[:5] = np.nan
    values[n // 2 : n // 2 + 121] = np.nan
    values[-7:] = np.nan
    return values


def column(df, name="x", order="datetime"):
    """Values in time order; nulls as None."""
    return [r[0] for r in df.orderBy(order).select(name).collect()]


def known(values):
    return [None if pd.isna(v) else float(v) for v in values]


def close(got, want, digits=9):
    got = [None if g is None else round(g, digits) + 0.0 for g in got]
    want = [None if pd.isna(w) else round(float(w), digits) + 0.0 for w in want]
    return got == want
