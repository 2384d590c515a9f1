"""Fills and rolling figures: block-wise results against pandas on the whole series."""

import datetime as dt

import pandas as pd
import pytest
from frames import START, close, column, gappy, known, series

from squall.operators.axis import fill_gaps
from squall.operators.blocks import DAY, HOUR, fitting_width, range_blocks, row_index
from squall.operators.encode import factorize
from squall.operators.missing import (
    ffill,
    fill_mean,
    fill_rules,
    fill_zero,
    impute_by_rule,
    interpolate_time,
)
from squall.operators.rolling import rolling_mean, rolling_sum

AXIS = {"ts": "datetime", "keys": ["station"]}
# Widths that cut 1,000 hours into many blocks, one block, and measured blocks; the last two force
# blocks of at most 40 rows, and range partitions.
BLOCKS = [
    {"width": 24 * HOUR}, {"width": 7 * HOUR}, {"width": 3600 * DAY}, {},
    {"max_rows": 40}, {"max_rows": 0},
]


@pytest.fixture(scope="module")
def walk(spark):
    values = gappy()
    return values, series(spark, known(values)).repartition(5).cache()


@pytest.mark.parametrize("blocks", BLOCKS, ids=str)
def test_ffill_blocks(walk, blocks):
    values, df = walk
    blocks = {k: max(v, 1) for k, v in blocks.items()}
    assert close(column(ffill(df, ["x"], **AXIS, **blocks)), values.ffill())


@pytest.mark.parametrize("blocks", BLOCKS, ids=str)
def test_interpolate_blocks(walk, blocks):
    values, df = walk
    blocks = {k: max(v, 1) for k, v in blocks.items()}
    index = pd.date_range(START, periods=len(values), freq="h")
    want = values.set_axis(index).interpolate(method="time")
    assert close(column(interpolate_time(df, ["x"], **AXIS, **blocks)), want)


@pytest.mark.parametrize("blocks", BLOCKS, ids=str)
def test_rolling_blocks(spark, blocks):
    values = gappy(400, share=0.03)
    blocks = {k: max(v, 1) for k, v in blocks.items()}
    df = series(spark, known(values))
    assert close(column(rolling_mean(df, "x", "r", **AXIS, **blocks), "r"), values.rolling(24).mean())
    assert close(column(rolling_sum(df, "x", "r", **AXIS, **blocks), "r"), values.rolling(24).sum())


@pytest.mark.parametrize("n", [1, 23, 24, 25])
def test_rolling_short_series(spark, n):
    got = column(rolling_mean(series(spark, [float(i) for i in range(n)]), "x", "r", **AXIS), "r")
    assert got[:23] == [None] * min(n, 23)
    assert got[23:] == [11.5 + i for i in range(n - 23)]


def test_rolling_counts_rows_not_hours(spark):
    """Rows far apart still fill a frame, even if every block holds only one of them."""
    df = series(spark, [float(i) for i in range(30)], step=dt.timedelta(days=3))
    got = column(rolling_sum(df, "x", "r", rows=4, width=DAY, **AXIS), "r")
    assert got == [None] * 3 + [float(4 * i - 6) for i in range(3, 30)]


def test_rolling_of_one_row(spark):
    assert column(rolling_sum(series(spark, [1.0, None, 3.0]), "x", "r", rows=1, **AXIS), "r") == [
        1.0, None, 3.0,
    ]


def test_stations_do_not_mix(spark):
    a = series(spark, [None, 1.0, None], "a")
    b = series(spark, [5.0, None, None], "b")
    both = a.unionByName(b)
    filled = ffill(both, ["x"], **AXIS).orderBy("station", "datetime")
    assert [r.x for r in filled.collect()] == [None, 1.0, 1.0, 5.0, 5.0, 5.0]
    without_keys = ffill(a, ["x"], ts="datetime")
    assert column(without_keys) == [None, 1.0, 1.0]


def test_equal_times_are_ordered_by_ties(spark):
    rows = [(START, 2, None), (START, 1, 7.0), (START, 3, 9.0), (START, 4, None)]
    df = spark.createDataFrame(rows, "datetime timestamp, id int, x double")
    got = ffill(df, ["x"], ts="datetime", ties=["id"]).orderBy("id")
    assert [r.x for r in got.collect()] == [7.0, 7.0, 9.0, 9.0]


def test_fills_of_one_and_no_value(spark):
    alone = series(spark, [None, 3.0, None])
    assert column(interpolate_time(alone, ["x"], **AXIS)) == [None, 3.0, 3.0]
    empty = series(spark, [None, None])
    assert column(interpolate_time(empty, ["x"], **AXIS)) == [None, None]
    assert column(fill_mean(empty, ["x"])) == [None, None]
    assert column(fill_mean(alone, ["x"])) == [3.0, 3.0, 3.0]
    assert column(fill_zero(alone, ["x"])) == [0.0, 3.0, 0.0]


def test_rules_by_name():
    assert fill_rules(
        ["rain", "rain_sum", "soil_temperature_0cm", "surface_pressure", "vapour_pressure_deficit",
         "relative_humidity_2m", "cape"]
    ) == {
        "rain": "zero",
        "rain_sum": "mean",
        "soil_temperature_0cm": "interpolate",
        "surface_pressure": "interpolate",
        "vapour_pressure_deficit": "interpolate",
        "relative_humidity_2m": "interpolate",
        "cape": "mean",
    }


def test_impute_by_rule(spark):
    rows = [
        (START + dt.timedelta(hours=i), t, r, c, None, None)
        for i, (t, r, c) in enumerate([(None, None, 1.0), (1.0, 2.0, None), (None, None, 2.0), (3.0, 1.0, 3.0)])
    ]
    df = spark.createDataFrame(
        rows,
        "datetime timestamp, temperature_2m double, rain double, cape double, showers double, e double",
    )
    cols = ["temperature_2m", "rain", "cape", "showers", "e"]
    got = impute_by_rule(df, cols, ts="datetime").orderBy("datetime")
    assert [tuple(r)[1:] for r in got.collect()] == [
        (None, 0.0, 1.0, 0.0, None), (1.0, 2.0, 2.0, 0.0, None),
        (2.0, 0.0, 2.0, 0.0, None), (3.0, 1.0, 3.0, 0.0, None),
    ]


@pytest.mark.parametrize("max_rows", [1, 10, 1000])
def test_row_index(spark, max_rows):
    df = series(spark, [0.0] * 100).unionByName(series(spark, [0.0] * 30, "b"))
    numbered = row_index(df, "n", max_rows=max_rows, **AXIS)
    assert [r.n for r in numbered.orderBy("station", "datetime").collect()] == [
        *range(1, 101), *range(1, 31),
    ]


def test_block_width_follows_the_density(spark):
    df = series(spark, [0.0] * 200)
    assert fitting_width(df, "datetime", ["station"], 1000) == 360 * DAY
    assert fitting_width(df, "datetime", ["station"], 24) == DAY
    assert fitting_width(df, "datetime", ["station"], 1) == HOUR
    assert fitting_width(df, "datetime", ["station"], 0) is None


def test_range_blocks_split_one_instant(spark):
    """A burst at a single time in a single station is still cut into even blocks."""
    rows = [("a", START, i, float(i) if i % 10 == 0 else None) for i in range(1000)]
    df = spark.createDataFrame(rows, "station string, datetime timestamp, id int, x double")
    sizes = [
        r["count"]
        for r in range_blocks(df, ["station", "datetime", "id"], 100).groupBy("__block").count().collect()
    ]
    assert sum(sizes) == 1000 and len(sizes) > 5 and max(sizes) < 250
    filled = ffill(df, ["x"], ties=["id"], max_rows=100, **AXIS).orderBy("id")
    assert [r.x for r in filled.collect()] == [float(i - i % 10) for i in range(1000)]


@pytest.mark.parametrize("keys", [[], ["station"]])
def test_factorize(spark, keys):
    labels = ["Summer", "Fall", None, "Summer", "Winter", "Fall"]
    rows = [("a", START + dt.timedelta(days=i), s) for i, s in enumerate(labels)]
    df = spark.createDataFrame(rows, "station string, datetime timestamp, season string")
    got = column(factorize(df, "season", ts="datetime", keys=keys), "season")
    assert got == list(pd.factorize(pd.Series(labels))[0])
    in_blocks = factorize(df, "season", ts="datetime", keys=keys, max_rows=1)
    assert column(in_blocks, "season") == got


def test_results_do_not_depend_on_partitioning(walk):
    _, df = walk
    for op in (ffill, interpolate_time):
        one = op(df.repartition(1), ["x"], width=DAY, **AXIS).orderBy("datetime").collect()
        many = op(df.repartition(17), ["x"], width=DAY, **AXIS).orderBy("datetime").collect()
        assert one == many


@pytest.mark.parametrize("width", [HOUR, 5 * HOUR, DAY])
def test_rolling_over_more_rows_than_blocks_hold(spark, width):
    values = gappy(2300, share=0.0)
    df = series(spark, known(values)).repartition(4)
    got = column(rolling_sum(df, "x", "r", rows=2000, width=width, **AXIS), "r")
    assert close(got, values.rolling(2000).sum())


def test_rolling_keeps_the_columns_in_their_order(spark):
    df = series(spark, [float(i) for i in range(30)])
    assert rolling_mean(df, "x", "r", rows=3, width=HOUR, **AXIS).columns == [*df.columns, "r"]


@pytest.mark.parametrize("blocks", [{"width": 3 * HOUR}, {}, {"max_rows": 3}], ids=str)
def test_gaps_are_filled_over_each_keys_own_span(spark, blocks):
    hours = {"a": [0, 1, 5, 6, 30], "b": [12], "c": [3, 3, 7]}
    rows = [(s, START + dt.timedelta(hours=h), float(k)) for s, at in hours.items() for k, h in enumerate(at)]
    df = spark.createDataFrame(rows, "station string, datetime timestamp, x double")
    ties = {"ties": ["x"]} if blocks.get("max_rows") else {}
    got = fill_gaps(df, "datetime", "1 hour", ["station"], **blocks, **ties)
    assert got.columns == df.columns and got.schema == df.schema
    found = sorted((r.station, r.datetime, r.x is None, r.x or 0.0) for r in got.collect())
    want = []
    for s, at in hours.items():
        want += [(s, START + dt.timedelta(hours=h), False, float(k)) for k, h in enumerate(at)]
        missing = set(range(min(at), max(at))) - set(at)
        want += [(s, START + dt.timedelta(hours=h), True, 0.0) for h in missing]
    assert found == sorted(want)
    days = spark.createDataFrame([(START.date(), 1.0), (START.date() + dt.timedelta(days=3), 2.0)], "date date, x double")
    assert sorted(r.x or 0 for r in fill_gaps(days, "date", "1 day").collect()) == [0, 0, 1.0, 2.0]
    assert fill_gaps(days.limit(0), "date", "1 day").count() == 0
