import datetime as dt
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from squall.operators.axis import regular_grid, time_axis
from squall.sources.responses import ingest_daily, ingest_hourly, length_violations, read_responses
from squall.sources.schemas import (
    DAILY_REQUESTED,
    DAILY_VARIABLES,
    HOURLY_SCHEMA,
    HOURLY_VARIABLES,
    RESPONSE_SCHEMA,
)
from squall.sources.tables import (
    read_csv,
    read_observations,
    select_variables,
    source_filter,
    write_csv,
    write_observations,
    write_sensitivity,
)
from squall.storage import CHECKPOINT_DIR, materialise, shared_dir

T0 = dt.datetime(2024, 1, 1)


def response(spark, variables, hours=3, step=3_600):
    row = ("a", T0, T0 + dt.timedelta(seconds=hours * step), step, variables)
    return spark.createDataFrame([row], RESPONSE_SCHEMA)


def test_variable_lists():
    assert len(DAILY_VARIABLES) == 22 and len(DAILY_REQUESTED) == 16 and len(HOURLY_VARIABLES) == 50
    assert set(DAILY_REQUESTED) < set(DAILY_VARIABLES)


def test_hourly_response_by_name(spark):
    rows = ingest_hourly(
        response(spark, {"rain": [1.0, 2.0, 3.0], "temperature_2m": [7.0, float("nan"), None]})
    )
    assert rows.columns == [f.name for f in HOURLY_SCHEMA]
    got = rows.orderBy("datetime").select("datetime", "temperature_2m", "rain", "cape").collect()
    assert [tuple(r) for r in got] == [
        (T0, 7.0, 1.0, None),
        (T0 + dt.timedelta(hours=1), None, 2.0, None),
        (T0 + dt.timedelta(hours=2), None, 3.0, None),
    ]


@pytest.mark.parametrize("values", [[1.0, 2.0], [1.0, 2.0, 3.0, 4.0], []])
def test_arrays_that_do_not_fit_the_axis_are_refused(spark, values):
    answers = response(spark, {"rain": values, "temperature_2m": [1.0, 2.0, 3.0], "cape": None})
    with pytest.raises(Exception, match=f"rain of a has {len(values)} values on an axis of 3"):
        ingest_hourly(answers).collect()
    found = [tuple(r) for r in length_violations(answers).collect()]
    assert found == [("a", T0, "rain", len(values), 3)]


def test_requested_daily_variables_land_under_their_names(spark):
    values = {v: [float(i)] for i, v in enumerate(DAILY_REQUESTED)}
    row = ingest_daily(response(spark, values, hours=1, step=86_400)).first().asDict()
    assert row["date"] == T0.date()
    assert {v: row[v] for v in DAILY_REQUESTED} == {v: x[0] for v, x in values.items()}
    assert all(row[v] is None for v in DAILY_VARIABLES if v not in DAILY_REQUESTED)


def test_responses_from_json(spark, tmp_path):
    response(spark, {"rain": [1.0, None, 3.0]}).write.option("ignoreNullFields", False).json(
        str(tmp_path / "r")
    )
    rows = ingest_hourly(read_responses(spark, str(tmp_path / "r")), ["rain"])
    assert [r.rain for r in rows.orderBy("datetime").collect()] == [1.0, None, 3.0]


@pytest.mark.parametrize("hours, points", [(0, 0), (1, 1), (5, 5)])
def test_axis_is_half_open(spark, hours, points):
    df = spark.createDataFrame([(T0, T0 + dt.timedelta(hours=hours))], "a timestamp, b timestamp")
    axis = df.select(time_axis(F.col("a"), F.col("b"), F.expr("interval 1 hour"))).first()[0]
    assert axis == [T0 + dt.timedelta(hours=i) for i in range(points)]


def test_regular_grid_fills_gaps(spark):
    rows = [("a", dt.date(2024, 2, 27), 1.0), ("b", dt.date(2024, 3, 1), 2.0)]
    df = spark.createDataFrame(rows, "station string, date date, x double")
    grid = regular_grid(df, "date", "1 day", ["station"])
    assert grid.schema["date"].dataType == df.schema["date"].dataType
    assert grid.count() == 8 and grid.filter("x is not null").count() == 2
    assert regular_grid(df.drop("station"), "date", "1 day").count() == 4


def test_csv_round_trip_and_overwrite(spark, tmp_path):
    path = str(tmp_path / "t")
    first = spark.createDataFrame([(1, 2), (3, 4)], "col1 int, col2 int")
    write_csv(first, path)
    write_csv(first.filter("col1 = 1"), path)
    assert [tuple(r) for r in read_csv(spark, path, first.schema).collect()] == [(1, 2)]


def test_csv_with_other_columns_is_refused(spark, tmp_path):
    path = str(tmp_path / "t")
    write_csv(spark.createDataFrame([(1, 2)], "col1 int, col2 int"), path)
    other = spark.createDataFrame([], "col1 int, col3 int").schema
    with pytest.raises(Exception, match="CSV header does not conform|col3"):
        read_csv(spark, path, other).collect()


def test_nan_text_is_missing(spark, tmp_path):
    df = spark.createDataFrame([(float("nan"),), (1.0,)], "x double")
    write_csv(df, str(tmp_path / "t"))
    got = read_csv(spark, str(tmp_path / "t"), df.schema).collect()
    assert sorted((r.x for r in got), key=str) == [1.0, None]


def test_observations_prune_and_push_filters(spark, tmp_path):
    rows = [("a", T0 + dt.timedelta(days=d), float(d)) for d in range(90)]
    df = spark.createDataFrame(rows, "station string, datetime timestamp, x double")
    write_observations(df, str(tmp_path / "o"), "datetime")
    stored = read_observations(spark, str(tmp_path / "o"))
    picked = source_filter(stored, "datetime", "2024-02-10", "2024-02-20", ["a"], by_month=True)
    picked = picked.select("x")
    assert picked.count() == 11
    folders = picked.select("_metadata.file_path").distinct().collect()
    assert all("/year=2024/month=2/" in r.file_path for r in folders)
    plan = picked._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: []" not in plan and "month" in plan.split("PartitionFilters")[1]
    assert "GreaterThanOrEqual(datetime" in plan and "station" in plan.split("PushedFilters")[1]
    assert "ReadSchema: struct<station:string,datetime:timestamp,x:double>" in plan


def test_source_filter_by_table(spark):
    df = spark.createDataFrame([("a", T0), ("b", T0)], "station string, datetime timestamp")
    stations = spark.createDataFrame([("b",)], "station string")
    assert [r.station for r in source_filter(df, "datetime", stations=stations).collect()] == ["b"]


def test_select_variables_adds_missing_ones(spark):
    df = spark.createDataFrame([("a", 1.0)], "station string, x double")
    got = select_variables(df, ["station"], ["x", "y"])
    assert got.columns == ["station", "x", "y"] and got.first().y is None


def test_sensitivity_folders(spark, tmp_path):
    table = spark.createDataFrame(
        [("t1", "month", 1, 0.5), ("t2", "month", 1, 0.7)],
        "target string, feature string, value int, average_prediction double",
    )
    write_sensitivity(table, str(tmp_path / "s"))
    assert sorted(p.name for p in (tmp_path / "s").glob("target=*")) == ["target=t1", "target=t2"]


def fake_session(master, folder=None):
    context = SimpleNamespace(master=master, applicationId="app-test")
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: folder or default), sparkContext=context
    )


def test_scratch_folder_is_the_one_the_session_names(spark):
    assert shared_dir(fake_session("yarn", "hdfs:///shared/")) == "hdfs:///shared"
    local = fake_session("local[2]")
    assert shared_dir(local) == shared_dir(local)
    with pytest.raises(RuntimeError, match=CHECKPOINT_DIR):
        shared_dir(fake_session("yarn"))
    table = materialise(spark.range(3), "numbers")
    assert table.count() == 3
    assert all(shared_dir(spark) in f for f in table.inputFiles())
