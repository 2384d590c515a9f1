"""Training, prediction, analysis and monitoring.

Tree models cannot be repeated in SQL, so their queries are checked for their rows only. Every
operator around them also runs with the closed-form climatology, which SQL can repeat.
"""

from pyspark.sql import functions as F

from squall.models.analysis import (
    DAILY_PERTURBATIONS,
    HOURLY_PERTURBATIONS,
    bias_analysis,
    evaluate,
    sensitivity_analysis,
)
from squall.models.features import (
    DAILY_FEATURES,
    DAILY_TARGETS,
    HOURLY_FEATURES,
    HOURLY_TARGETS,
    combinations,
    train_test_split,
    training_extract,
)
from squall.models.forecast import (
    daily_calendar,
    forecast_daily,
    forecast_digest,
    forecast_hourly,
    hourly_calendar,
    predict_single_date,
)
from squall.models.predictors import (
    CLIMATOLOGY,
    first_split,
    fit_climatology,
    load_models,
    predict_batch,
    prediction,
    train_models,
)
from squall.models.retrain import models_in_force, monitor_models, retrain_if_degraded
from squall.models.splits import best_split, split_candidates
from squall.operators.metrics import (
    DAILY_THRESHOLDS,
    HOURLY_THRESHOLDS,
    error_metrics,
    monitor,
    retrain_needed,
)
from squall.operators.scaling import minmax_fit, minmax_scale
from squall.plans.modelling import model_daily, model_hourly
from squall.sources.tables import read_csv, write_sensitivity
from squall.storage import scratch_path
from squall.versions import Versions
from suite.registry import case, day, num, nums, stamp
from suite.views import DAILY_CTE, READINGS_CTE, STATION, daily, readings

AS_OF = "1998-08-02"
FORECAST_DATES = ["2024-01-30", "2024-01-31"]


def _observed(spark, sf_dir):
    """Readings with the hourly targets."""
    return readings(spark, sf_dir).withColumns(
        {
            "apparent_temperature": F.col("temperature_2m") - F.col("wind_speed_10m") / 4,
            "rain": F.coalesce("rain", F.lit(0.0)),
        }
    )


def _daily_extract(spark, sf_dir):
    rows = daily(spark, sf_dir).select(*STATION, "date", *DAILY_TARGETS)
    return training_extract(rows, "date", hourly=False)


def _hourly_extract(spark, sf_dir):
    rows = _observed(spark, sf_dir).select("event_id", *STATION, "datetime", *HOURLY_TARGETS)
    return training_extract(rows, "datetime", hourly=True)


CALENDAR = (
    "cast(month({0}) as int) as month, cast(dayofyear({0}) as int) as day_of_year, "
    "cast(weekofyear({0}) as int) as week_of_year, cast(isodow({0}) >= 6 as int) as is_weekend"
)
DAILY_OBS = (
    f"{DAILY_CTE}, obs as (select station, date, apparent_temperature_max, "
    f"{CALENDAR.format('date')} from daily)"
)
HOURLY_OBS = (
    f"{READINGS_CTE}, obs as (select event_id, station, datetime, "
    "temperature_2m - wind_speed_10m / 4 as apparent_temperature, precipitation, "
    f"coalesce(rain, 0) as rain, cast(hour(datetime) as int) as hour, {CALENDAR.format('datetime')} "
    "from readings)"
)


def scored_sql(targets, train: str = "obs", rows: str = "obs") -> str:
    """CTEs `climate` and `scored`: climatology fitted on `train`, applied to `rows`."""
    means = ", ".join(f"avg({t}) as m_{t}" for t in targets)
    overall = ", ".join(f"avg({t}) as o_{t}" for t in targets)
    values = ", ".join(f"coalesce(m_{t}, o_{t}) as {t}_prediction" for t in targets)
    return f"""climate as (select month, is_weekend, {means} from {train} group by 1, 2),
    overall as (select {overall} from {train}),
    scored as (select r.*, {values} from {rows} r
               left join climate using (month, is_weekend) cross join overall)"""


def metrics_sql(targets, view: str = "scored") -> str:
    return " union all ".join(
        f"""select '{t}' as target, count(e) as n, avg(abs(e)) as mae, sqrt(avg(e * e)) as rmse,
        case when var_pop(y) > 0 then 1 - avg(e * e) / var_pop(y)
             when avg(e * e) = 0 then 1 when avg(e * e) is not null then 0 end as r2,
        avg(e) as bias
        from (select {t}_prediction - {t} as e,
                     case when {t}_prediction is not null then {t} end as y from {view})"""
        for t in targets
    )


METRICS = f"select target, n, {nums('mae', 'rmse', 'r2', 'bias')}"


def _daily_models(spark, sf_dir):
    return train_models(_daily_extract(spark, sf_dir), DAILY_FEATURES, DAILY_TARGETS)


def _hourly_models(spark, sf_dir):
    return train_models(_hourly_extract(spark, sf_dir), HOURLY_FEATURES, HOURLY_TARGETS)


@case(
    "training_extract",
    f"with {DAILY_OBS} select station, {day('date', 'date')}, {nums('apparent_temperature_max')}, "
    "month, day_of_year, week_of_year, is_weekend from obs",
)
def _training_extract(spark, sf_dir):
    return _daily_extract(spark, sf_dir)


@case(
    "training_extract_hourly",
    f"with {HOURLY_OBS} select event_id, station, {stamp('datetime', 'datetime')}, "
    f"{nums(*HOURLY_TARGETS)}, hour, month, day_of_year, week_of_year, is_weekend from obs",
)
def _training_extract_hourly(spark, sf_dir):
    return _hourly_extract(spark, sf_dir)


TEST_SQL = (
    "cast('0x' || substr(md5(station || '|' || event_id || '|42'), 1, 8) as bigint) % 100 < 20"
)


@case(
    "train_test_split",
    f"with {READINGS_CTE} select event_id, {TEST_SQL} as is_test from readings",
)
def _split(spark, sf_dir):
    rows = readings(spark, sf_dir)
    train, test = train_test_split(rows, ["station", "event_id"])
    return (
        train.select("event_id", F.lit(False).alias("is_test"))
        .unionByName(test.select("event_id", F.lit(True).alias("is_test")))
    )


@case("train_models")
def _train(spark, sf_dir):
    """Importance of every feature for every target of freshly trained models."""
    models = train_models(_hourly_extract(spark, sf_dir), HOURLY_FEATURES, HOURLY_TARGETS)
    rows = []
    for target, model in models.models.items():
        weights = model.stages[-1].featureImportances.toArray()
        rows += [(target, f, float(w)) for f, w in zip(HOURLY_FEATURES, weights)]
    return spark.createDataFrame(rows, "target string, feature string, importance double")


def _split_candidates_sql(features, target: str) -> str:
    """CTEs up to `cuts_{target}`: every threshold of every feature with both means and its gain."""
    values = " union all ".join(
        f"select {k} as place, '{f}' as feature, cast({f} as double) as value, count(*) as n, "
        f"sum({target}) as s from obs where {target} is not null group by 3"
        for k, f in enumerate(features)
    )
    return f"""values_{target} as ({values}),
    sums_{target} as (select place, feature, (value + lead(value) over w) / 2 as threshold,
        sum(n) over w as nl, sum(s) over w as sl, sum(n) over (partition by place) as n_all,
        sum(s) over (partition by place) as s_all from values_{target}
        window w as (partition by place order by value)),
    cuts_{target} as (select place, feature, threshold, sl / nl as left_mean,
        (s_all - sl) / (n_all - nl) as right_mean,
        nl * (n_all - nl) / (n_all * n_all) * pow(sl / nl - (s_all - sl) / (n_all - nl), 2) as gain
        from sums_{target} where threshold is not null)"""


@case(
    "train_first_split",
    f"with {HOURLY_OBS}, " + ", ".join(_split_candidates_sql(HOURLY_FEATURES, t) for t in HOURLY_TARGETS)
    + " " + " union all ".join(
        f"(select '{t}' as target, feature, {nums('threshold', 'left_mean', 'right_mean', 'gain')}, "
        f"true as tree_agrees from cuts_{t} "
        f"where gain >= (select max(gain) from cuts_{t}) * (1 - 1e-9) order by place, threshold limit 1)"
        for t in HOURLY_TARGETS
    ),
)
def _first_split(spark, sf_dir):
    """The best split of each target by prefix sums, and whether a trained tree of depth one is cut there.

    Of features that cut the rows alike the tree may take any: it must take one of the best gain, and its
    leaves must be the means of that cut's sides.
    """
    extract = _hourly_extract(spark, sf_dir)
    stumps = train_models(extract, HOURLY_FEATURES, HOURLY_TARGETS, trees=1, depth=1)
    combos = combinations(extract, HOURLY_FEATURES, HOURLY_TARGETS)
    trained = {t: (f, *numbers) for t, f, *numbers in first_split(stumps)}
    found = []
    for target in HOURLY_TARGETS:
        best = best_split(combos, HOURLY_FEATURES, target)
        feature, threshold, left, right = trained[target]
        same = split_candidates(combos, HOURLY_FEATURES, target).filter(
            (F.col("feature") == feature)
            & (F.abs(F.col("threshold") - threshold) < 1e-9)
            & (F.abs(F.col("left_mean") - left) < 1e-9)
            & (F.abs(F.col("right_mean") - right) < 1e-9)
        )
        gain = same.agg(F.max("gain")).scalar()
        agrees = F.coalesce(gain >= F.col("gain") * (1 - 1e-9), F.lit(False))
        found.append(best.withColumn("tree_agrees", agrees))
    return found[0].unionByName(found[1]).unionByName(found[2])


@case(
    "model_save_load",
    f"with {DAILY_OBS} select count(*) as rows, cast(0 as double) as largest_difference from obs",
)
def _save_load(spark, sf_dir):
    """Predictions of the saved and reloaded models against those of the originals."""
    models = _daily_models(spark, sf_dir)
    folder = scratch_path(spark, "models")
    models.save(folder)
    again = load_models(folder, DAILY_TARGETS, DAILY_FEATURES)
    extract = _daily_extract(spark, sf_dir)
    target = DAILY_TARGETS[0]
    both = again.score(models.score(extract).withColumnRenamed(prediction(target), "original"))
    return both.agg(
        F.count(F.lit(1)).alias("rows"),
        F.max(F.abs(F.col("original") - F.col(prediction(target)))).alias("largest_difference"),
    )


@case("holdout_evaluation")
def _holdout(spark, sf_dir):
    train, test = train_test_split(_hourly_extract(spark, sf_dir), ["station", "event_id"])
    models = train_models(train, HOURLY_FEATURES, HOURLY_TARGETS)
    return evaluate(models, test)


@case(
    "holdout_evaluation_climatology",
    f"with {HOURLY_OBS}, train as (select * from obs where not ({TEST_SQL})), "
    f"test as (select * from obs where {TEST_SQL}), "
    f"{scored_sql(HOURLY_TARGETS, 'train', 'test')} {METRICS} from ({metrics_sql(HOURLY_TARGETS)})",
)
def _holdout_climatology(spark, sf_dir):
    train, test = train_test_split(_hourly_extract(spark, sf_dir), ["station", "event_id"])
    return evaluate(fit_climatology(train, HOURLY_TARGETS), test)


@case(
    "error_metrics",
    f"with {READINGS_CTE}, pairs as (select station, temperature_2m as y, "
    "dew_point_2m * 2 + 41 as p from readings) "
    f"select station, 'temperature_2m' as target, count(e) as n, {num('avg(abs(e))', 'mae')}, "
    f"{num('sqrt(avg(e * e))', 'rmse')}, {num('1 - avg(e * e) / var_pop(y)', 'r2')}, "
    f"{num('avg(e)', 'bias')} from (select station, y, p - y as e from pairs) group by 1",
)
def _error_metrics(spark, sf_dir):
    rows = readings(spark, sf_dir).withColumn("p", F.col("dew_point_2m") * 2 + 41)
    return error_metrics(rows, {"temperature_2m": ("temperature_2m", "p")}, STATION)


@case("predict_batch")
def _predict(spark, sf_dir):
    scored = predict_batch(_hourly_models(spark, sf_dir), _hourly_extract(spark, sf_dir))
    return scored.select("event_id", *[prediction(t) for t in HOURLY_TARGETS])


@case(
    "predict_batch_climatology",
    f"with {HOURLY_OBS}, {scored_sql(HOURLY_TARGETS)} "
    f"select event_id, {nums(*[f'{t}_prediction' for t in HOURLY_TARGETS])} from scored",
)
def _predict_climatology(spark, sf_dir):
    extract = _hourly_extract(spark, sf_dir)
    scored = predict_batch(fit_climatology(extract, HOURLY_TARGETS), extract)
    return scored.select("event_id", *[prediction(t) for t in HOURLY_TARGETS])


def sensitivity_sql(targets, perturbations) -> str:
    """Mean climatology prediction with one feature fixed; only the month matters to it."""
    cases = [(f, v) for f, values in perturbations.items() for v in values]
    return " union all ".join(
        f"""select '{t}' as target, '{f}' as feature, cast({v} as int) as value,
        {num(f'avg(coalesce(m_{t}, o_{t}))', 'average_prediction')}
        from (select {v if f == 'month' else 'month'} as month, is_weekend from obs) r
        left join climate using (month, is_weekend) cross join overall"""
        for t in targets
        for f, v in cases
    )


_CLIMATE_DAILY = scored_sql(DAILY_TARGETS).split("scored as")[0].rstrip().rstrip(",")
_CLIMATE_HOURLY = scored_sql(HOURLY_TARGETS).split("scored as")[0].rstrip().rstrip(",")


@case("sensitivity_analysis")
def _sensitivity(spark, sf_dir):
    models, extract = _hourly_models(spark, sf_dir), _hourly_extract(spark, sf_dir)
    return sensitivity_analysis(models, extract, HOURLY_FEATURES, HOURLY_PERTURBATIONS)


@case("sensitivity_analysis_daily")
def _sensitivity_daily(spark, sf_dir):
    models, extract = _daily_models(spark, sf_dir), _daily_extract(spark, sf_dir)
    return sensitivity_analysis(models, extract, DAILY_FEATURES, DAILY_PERTURBATIONS)


@case(
    "sensitivity_climatology_daily",
    f"with {DAILY_OBS}, {_CLIMATE_DAILY} {sensitivity_sql(DAILY_TARGETS, DAILY_PERTURBATIONS)}",
)
def _sensitivity_climatology_daily(spark, sf_dir):
    extract = _daily_extract(spark, sf_dir)
    model = fit_climatology(extract, DAILY_TARGETS)
    return sensitivity_analysis(model, extract, DAILY_FEATURES, DAILY_PERTURBATIONS)


@case(
    "sensitivity_climatology_hourly",
    f"with {HOURLY_OBS}, {_CLIMATE_HOURLY} {sensitivity_sql(HOURLY_TARGETS, HOURLY_PERTURBATIONS)}",
)
def _sensitivity_climatology_hourly(spark, sf_dir):
    extract = _hourly_extract(spark, sf_dir)
    model = fit_climatology(extract, HOURLY_TARGETS)
    return sensitivity_analysis(model, extract, HOURLY_FEATURES, HOURLY_PERTURBATIONS)


@case(
    "sink_sensitivity",
    f"with {DAILY_OBS}, {_CLIMATE_DAILY} {sensitivity_sql(DAILY_TARGETS, DAILY_PERTURBATIONS)}",
)
def _sink_sensitivity(spark, sf_dir):
    table = _sensitivity_climatology_daily(spark, sf_dir)
    path = scratch_path(spark, "sensitivity")
    write_sensitivity(table, path)
    target = DAILY_TARGETS[0]
    stored = read_csv(spark, f"{path}/target={target}", table.drop("target").schema)
    return stored.select(F.lit(target).alias("target"), *stored.columns)


@case("bias_analysis")
def _bias(spark, sf_dir):
    return bias_analysis(_hourly_models(spark, sf_dir), _hourly_extract(spark, sf_dir))[0]


@case(
    "bias_analysis_climatology",
    f"with {HOURLY_OBS}, {scored_sql(HOURLY_TARGETS)} "
    f"{METRICS} from ({metrics_sql(HOURLY_TARGETS)})",
)
def _bias_climatology(spark, sf_dir):
    extract = _hourly_extract(spark, sf_dir)
    return bias_analysis(fit_climatology(extract, HOURLY_TARGETS), extract)[0]


@case(
    "bias_chart_climatology",
    f"""with {DAILY_OBS}, {scored_sql(DAILY_TARGETS)},
    pairs as (select apparent_temperature_max as a, apparent_temperature_max_prediction as p from scored),
    e as (select least(min(a), min(p)) as lo, greatest(max(a), max(p)) as hi from pairs),
    cells as (select cast(least(floor((a - lo) / (hi - lo) * 20), 19) as bigint) as actual_bin,
                     cast(least(floor((p - lo) / (hi - lo) * 20), 19) as bigint) as predicted_bin,
                     lo, hi, count(*) as n from pairs, e group by 1, 2, 3, 4)
    select actual_bin, predicted_bin,
           {num('lo + (hi - lo) * (actual_bin + 0.5) / 20', 'actual_mid')},
           {num('lo + (hi - lo) * (predicted_bin + 0.5) / 20', 'predicted_mid')}, n from cells""",
)
def _bias_chart(spark, sf_dir):
    extract = _daily_extract(spark, sf_dir)
    charts = bias_analysis(fit_climatology(extract, DAILY_TARGETS), extract, cells=20)[1]
    return charts[DAILY_TARGETS[0]]


def _stations(spark, sf_dir):
    return daily(spark, sf_dir).select("station").distinct()


@case("predict_single_date")
def _single_date(spark, sf_dir):
    return predict_single_date(
        _daily_models(spark, sf_dir), _stations(spark, sf_dir), AS_OF
    )


@case("forecast_daily")
def _forecast_daily(spark, sf_dir):
    """Models of scaled targets, predictions back in original units per station."""
    extract, targets = _daily_extract(spark, sf_dir), list(DAILY_TARGETS)
    scaler = minmax_fit(extract, targets, STATION)
    scaled = minmax_scale(extract, targets, STATION, scaler)
    models = train_models(scaled, DAILY_FEATURES, targets)
    return forecast_daily(models, _stations(spark, sf_dir), AS_OF, scaler, STATION)


@case("forecast_hourly")
def _forecast_hourly(spark, sf_dir):
    stations = readings(spark, sf_dir).select("station").distinct()
    return forecast_hourly(_hourly_models(spark, sf_dir), stations, FORECAST_DATES)


DATES_SQL = f"""dates as (
    select station, cast(unnest(generate_series(timestamp '{AS_OF}', timestamp '{AS_OF}' + interval 6 day,
           interval 1 day)) as date) as date from (select distinct station from daily))"""


@case(
    "forecast_calendar_daily",
    f"with {DAILY_CTE}, {DATES_SQL} "
    f"select station, {day('date', 'date')}, {CALENDAR.format('date')} from dates",
)
def _calendar_daily(spark, sf_dir):
    return daily_calendar(_stations(spark, sf_dir), AS_OF)


HOURS_SQL = """grid as (
    select station, date, cast(unnest(generate_series(0, 23)) as int) as hour
    from (select distinct station from readings),
         (values (date '2024-01-30'), (date '2024-01-31')) as d(date))"""


@case(
    "forecast_calendar_hourly",
    f"with {READINGS_CTE}, {HOURS_SQL} "
    f"select station, {day('date', 'date')}, hour, {CALENDAR.format('date')} from grid",
)
def _calendar_hourly(spark, sf_dir):
    stations = readings(spark, sf_dir).select("station").distinct()
    return hourly_calendar(stations, FORECAST_DATES)


_FORECAST_SQL = f"""{DAILY_OBS}, {DATES_SQL},
    scaler as (select station, min(apparent_temperature_max) as lo,
                      max(apparent_temperature_max) as hi from obs group by 1),
    fitted as (select obs.* replace (
                 round_even((apparent_temperature_max - lo) / nullif(hi - lo, 0) * 1000, 0) / 1000
                 as apparent_temperature_max) from obs join scaler using (station)),
    future as (select station, date, {CALENDAR.format('date')} from dates),
    {scored_sql(DAILY_TARGETS, 'fitted', 'future')},
    forecast as (select station, date, month, day_of_year, week_of_year, is_weekend,
                   apparent_temperature_max_prediction * (hi - lo) + lo as apparent_temperature_max
                 from scored join scaler using (station))"""


def _climatology_forecast(spark, sf_dir):
    extract, targets = _daily_extract(spark, sf_dir), list(DAILY_TARGETS)
    scaler = minmax_fit(extract, targets, STATION)
    model = fit_climatology(minmax_scale(extract, targets, STATION, scaler), targets)
    return forecast_daily(model, _stations(spark, sf_dir), AS_OF, scaler, STATION)


@case(
    "forecast_daily_climatology",
    f"with {_FORECAST_SQL} select station, {day('date', 'date')}, month, day_of_year, "
    f"week_of_year, is_weekend, {nums('apparent_temperature_max')} from forecast",
)
def _forecast_climatology(spark, sf_dir):
    return _climatology_forecast(spark, sf_dir)


@case(
    "forecast_hourly_climatology",
    f"with {HOURLY_OBS}, {HOURS_SQL}, future as (select station, date, hour, "
    f"{CALENDAR.format('date')} from grid), {scored_sql(HOURLY_TARGETS, 'obs', 'future')} "
    f"select station, {day('date', 'date')}, hour, month, day_of_year, week_of_year, is_weekend, "
    + ", ".join(num(f"{t}_prediction", t) for t in HOURLY_TARGETS)
    + " from scored",
)
def _forecast_hourly_climatology(spark, sf_dir):
    model = fit_climatology(_hourly_extract(spark, sf_dir), HOURLY_TARGETS)
    stations = readings(spark, sf_dir).select("station").distinct()
    return forecast_hourly(model, stations, FORECAST_DATES)


@case(
    "forecast_digest",
    f"with {_FORECAST_SQL} select station, '      date  apparent_temperature_max' || chr(10) || "
    "string_agg(strftime(cast(date as timestamp), '%Y-%m-%d') || '  ' || "
    "lpad(printf('%.2f', apparent_temperature_max), 24, ' '), chr(10) order by date) "
    "as digest from forecast group by 1",
)
def _digest(spark, sf_dir):
    forecast = _climatology_forecast(spark, sf_dir)
    return forecast_digest(forecast, "date", "apparent_temperature_max", STATION)


def monitor_sql(targets, rmse: float, r2: float) -> str:
    return (
        f"metrics as ({metrics_sql(targets)}), "
        f"flagged as (select *, coalesce(rmse > {rmse} or r2 < {r2}, false) as breach from metrics) "
        f"{METRICS}, breach, (select bool_or(breach) from flagged) as retrain_needed from flagged"
    )


@case(
    "monitor_models",
    f"with {HOURLY_OBS}, {scored_sql(HOURLY_TARGETS)}, {monitor_sql(HOURLY_TARGETS, 5.0, 0.08)}",
)
def _monitor(spark, sf_dir):
    extract = _hourly_extract(spark, sf_dir)
    return monitor_models(fit_climatology(extract, HOURLY_TARGETS), extract, HOURLY_THRESHOLDS)


@case(
    "monitor_models_since",
    f"with {DAILY_OBS}, recent as (select * from obs where date >= date '1997-01-01'), "
    f"{scored_sql(DAILY_TARGETS, 'obs', 'recent')}, {monitor_sql(DAILY_TARGETS, 5.0, 0.8)}",
)
def _monitor_since(spark, sf_dir):
    extract = _daily_extract(spark, sf_dir)
    model = fit_climatology(extract, DAILY_TARGETS)
    return monitor_models(model, extract, DAILY_THRESHOLDS, "date", "1997-01-01")


@case(
    "retrain_gate",
    f"with {READINGS_CTE}, e as (select temperature_2m as y, dew_point_2m * 2 + 41 - temperature_2m "
    "as d from readings) select sqrt(avg(d * d)) > 5 or 1 - avg(d * d) / var_pop(y) < 0.8 "
    "as retrain_needed from e where y is not null",
)
def _gate(spark, sf_dir):
    rows = readings(spark, sf_dir).withColumn("p", F.col("dew_point_2m") * 2 + 41)
    metrics = error_metrics(rows, {"temperature_2m": ("temperature_2m", "p")})
    needed = retrain_needed(monitor(metrics, DAILY_THRESHOLDS))
    return spark.createDataFrame([(needed,)], "retrain_needed boolean")


@case("retrain_if_degraded")
def _retrain(spark, sf_dir):
    """Metrics of the models in force after the gate, and whether they are new."""
    extract = _hourly_extract(spark, sf_dir)
    old = _hourly_models(spark, sf_dir)
    monitored = monitor_models(old, extract, HOURLY_THRESHOLDS)
    folder = scratch_path(spark, "retrained")
    models, fresh = retrain_if_degraded(old, extract, monitored, HOURLY_FEATURES, folder)
    return evaluate(models, extract).withColumn("retrained", F.lit(fresh))


@case(
    "predict_single_date_climatology",
    f"with {DAILY_OBS}, future as (select station, date, {CALENDAR.format('date')} from "
    f"(select distinct station, date '{AS_OF}' as date from daily)), "
    f"{scored_sql(DAILY_TARGETS, 'obs', 'future')} select station, {day('date', 'date')}, month, "
    f"day_of_year, week_of_year, is_weekend, "
    f"{num(f'{DAILY_TARGETS[0]}_prediction', DAILY_TARGETS[0])} from scored",
)
def _single_date_climatology(spark, sf_dir):
    model = fit_climatology(_daily_extract(spark, sf_dir), DAILY_TARGETS)
    return predict_single_date(model, _stations(spark, sf_dir), AS_OF)


def _bounds(function: str) -> str:
    return ", ".join(f"{function}({t}) as {function}_{t}" for t in HOURLY_TARGETS)


@case(
    "forecast_hourly_unscaled",
    f"with {HOURLY_OBS}, scaler as (select station, {_bounds('min')}, {_bounds('max')} from obs group by 1), "
    "fitted as (select obs.* replace ("
    + ", ".join(
        f"round_even(({t} - min_{t}) / nullif(max_{t} - min_{t}, 0) * 1000, 0) / 1000 as {t}"
        for t in HOURLY_TARGETS
    )
    + f") from obs join scaler using (station)), {HOURS_SQL}, future as (select station, date, hour, "
    f"{CALENDAR.format('date')} from grid), {scored_sql(HOURLY_TARGETS, 'fitted', 'future')} "
    f"select station, {day('date', 'date')}, hour, month, day_of_year, week_of_year, is_weekend, "
    + ", ".join(num(f"{t}_prediction * (max_{t} - min_{t}) + min_{t}", t) for t in HOURLY_TARGETS)
    + " from scored join scaler using (station)",
)
def _forecast_hourly_unscaled(spark, sf_dir):
    """A model of scaled targets; its forecast goes back to each station's units by the stored scaler."""
    extract, targets = _hourly_extract(spark, sf_dir), list(HOURLY_TARGETS)
    scaler = minmax_fit(extract, targets, STATION)
    model = fit_climatology(minmax_scale(extract, targets, STATION, scaler), targets)
    stations = readings(spark, sf_dir).select("station").distinct()
    return forecast_hourly(model, stations, FORECAST_DATES, scaler, STATION)


@case("daily_modelling")
def _model_daily(spark, sf_dir):
    rows = daily(spark, sf_dir).select(*STATION, "date", *DAILY_TARGETS)
    folder = scratch_path(spark, "daily-models")
    done = model_daily(rows, folder, AS_OF, [*STATION, "date"], STATION)
    return done.today.withColumn("retrained", F.lit(done.retrained))


@case("hourly_modelling")
def _model_hourly(spark, sf_dir):
    rows = _observed(spark, sf_dir).select("event_id", *STATION, "datetime", *HOURLY_TARGETS)
    folder = scratch_path(spark, "hourly-models")
    done = model_hourly(rows, folder, [*STATION, "event_id"])
    return done.monitored.withColumn("retrained", F.lit(done.retrained))


FIGURES = ("n", "mae", "rmse", "r2", "bias")


def _items(artifact: str, table, item: str, value: str):
    """Rows of a stored table as `(artifact, item, value)`."""
    return table.selectExpr(f"'{artifact}' as artifact", f"{item} as item", f"double({value}) as value")


def _figures(artifact: str, metrics):
    pairs = ", ".join(f"'{f}', double({f})" for f in FIGURES)
    long = metrics.selectExpr("target", f"stack({len(FIGURES)}, {pairs}) as (figure, value)")
    return _items(artifact, long, "target || ':' || figure", "value")


def _run_digest(done):
    """Everything a model run stored, and the version in force after it."""
    spark = done.bias.sparkSession
    cells = done.chart.groupBy("target").agg(F.count(F.lit(1)).alias("cells"), F.sum("n").alias("points"))
    parts = [
        _figures("bias", done.bias),
        _figures("holdout", done.holdout),
        _items("sensitivity", done.sensitivity, "target || ':' || feature || '=' || value", "average_prediction"),
        _items("chart", cells, "target || ':cells'", "cells"),
        _items("chart", cells, "target || ':points'", "points"),
        _items("monitored", done.monitored, "target", "int(breach)"),
        spark.createDataFrame(
            [("in force", "version", float(done.version)), ("in force", "retrained", float(done.retrained))],
            "artifact string, item string, value double",
        ),
        _items("manifest", done.manifest, "artifact", "rows"),
    ]
    if "today" in done.tables:
        parts.append(_items("today", done.today, "station", DAILY_TARGETS[0]))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _long_figures(artifact: str, view: str) -> str:
    return " union all ".join(
        f"select '{artifact}' as artifact, target || ':{f}' as item, cast({f} as double) as value from {view}"
        for f in FIGURES
    )


def _digest_sql(obs: str, test: str, targets, perturbations, rmse: float, r2: float, today: str = "") -> str:
    """SQL of `_run_digest` for a climatology: fitted on the rows that are not `test`, applied to all."""
    cells = " union all ".join(
        f"""select '{t}' as target, count(*) as cells, sum(n) as points from (
            select count(*) as n from (select {t} as a, {t}_prediction as p from scored
              where {t} is not null and {t}_prediction is not null) pairs,
              (select least(min({t}), min({t}_prediction)) as lo, greatest(max({t}), max({t}_prediction)) as hi
               from scored where {t} is not null and {t}_prediction is not null) e
            group by least(floor((a - lo) / (hi - lo) * 50), 49), least(floor((p - lo) / (hi - lo) * 50), 49))"""
        for t in targets
    )
    n_sensitivity = len(targets) * sum(map(len, perturbations.values()))
    counted = {
        "bias": len(targets), "holdout": len(targets), "monitored": len(targets),
        "sensitivity": n_sensitivity, "chart": "(select sum(cells) from cells)",
    }
    if today:
        counted["today"] = "(select count(*) from today)"
    manifest = " union all ".join(
        f"select 'manifest', '{name}', cast({n} as double)" for name, n in counted.items()
    )
    return f"""with {obs}, train as (select * from obs where not ({test})),
    {scored_sql(targets, 'train', 'obs')},
    bias as ({metrics_sql(targets)}),
    held as (select * from scored where {test}), holdout as ({metrics_sql(targets, 'held')}),
    steps as ({sensitivity_sql(targets, perturbations)}), cells as ({cells}),
    flagged as (select target, coalesce(rmse > {rmse} or r2 < {r2}, false) as breach from bias)
    {f', today as ({today})' if today else ''},
    digest as ({_long_figures('bias', 'bias')} union all {_long_figures('holdout', 'holdout')}
      union all select 'sensitivity', target || ':' || feature || '=' || value, average_prediction from steps
      union all select 'chart', target || ':cells', cells from cells
      union all select 'chart', target || ':points', points from cells
      union all select 'monitored', target, cast(breach as int) from flagged
      union all select 'in force', 'version', 1 + max(cast(breach as int)) from flagged
      union all select 'in force', 'retrained', max(cast(breach as int)) from flagged
      union all {manifest}
      {"union all select 'today', station, prediction from today" if today else ''})
    select artifact, item, {nums('value')} from digest"""


DAILY_TEST_SQL = TEST_SQL.replace("event_id", "date")


@case(
    "daily_modelling_climatology",
    _digest_sql(
        DAILY_OBS, DAILY_TEST_SQL, DAILY_TARGETS, DAILY_PERTURBATIONS, 5.0, 0.8,
        f"select station, coalesce(m_{DAILY_TARGETS[0]}, o_{DAILY_TARGETS[0]}) as prediction from "
        f"(select distinct station, cast(month(date '{AS_OF}') as int) as month, "
        f"cast(isodow(date '{AS_OF}') >= 6 as int) as is_weekend from obs) "
        "left join climate using (month, is_weekend) cross join overall",
    ),
)
def _model_daily_climatology(spark, sf_dir):
    """The whole daily model run with the closed-form model: every stored table and the version in force."""
    rows = daily(spark, sf_dir).select(*STATION, "date", *DAILY_TARGETS)
    folder = scratch_path(spark, "daily-models")
    return _run_digest(model_daily(rows, folder, AS_OF, [*STATION, "date"], STATION, family=CLIMATOLOGY))


@case(
    "hourly_modelling_climatology",
    _digest_sql(HOURLY_OBS, TEST_SQL, HOURLY_TARGETS, HOURLY_PERTURBATIONS, 5.0, 0.08),
)
def _model_hourly_climatology(spark, sf_dir):
    rows = _observed(spark, sf_dir).select("event_id", *STATION, "datetime", *HOURLY_TARGETS)
    folder = scratch_path(spark, "hourly-models")
    return _run_digest(model_hourly(rows, folder, [*STATION, "event_id"], family=CLIMATOLOGY))


SINCE = "1997-01-01"


@case(
    "retrain_since_climatology",
    f"""with {DAILY_OBS}, train as (select * from obs where not ({DAILY_TEST_SQL})),
    early as (select * from train where date < date '{SINCE}'),
    recent as (select * from obs where date >= date '{SINCE}'),
    old_model as (with {scored_sql(DAILY_TARGETS, 'early', 'recent')} {metrics_sql(DAILY_TARGETS)}),
    gate as (select bool_or(coalesce(rmse > 5.0 or r2 < 0.8, false)) as needed from old_model),
    taught as (select * from train where (select needed from gate) or date < date '{SINCE}'),
    new_model as (with {scored_sql(DAILY_TARGETS, 'taught', 'obs')} {metrics_sql(DAILY_TARGETS)}),
    both_models as (select 'judged' as stage, * from old_model union all select 'in force', * from new_model)
    select stage, target, n, {nums('mae', 'rmse', 'r2', 'bias')}, needed as retrained,
           cast(1 + cast(needed as int) as int) as version from both_models, gate""",
)
def _retrain_since(spark, sf_dir):
    """Models of the earlier years judged on the later ones, and the models in force after the gate, read
    back from the version that the pointer names."""
    rows = daily(spark, sf_dir).select(*STATION, "date", *DAILY_TARGETS)
    folder = scratch_path(spark, "daily-models")
    done = model_daily(
        rows, folder, AS_OF, [*STATION, "date"], STATION, since=SINCE, family=CLIMATOLOGY
    )
    models = models_in_force(Versions(spark, f"{folder}/models"), CLIMATOLOGY, DAILY_TARGETS, DAILY_FEATURES)
    judged = done.monitored.select("target", "n", "mae", "rmse", "r2", "bias").withColumn("stage", F.lit("judged"))
    now = evaluate(models, _daily_extract(spark, sf_dir)).withColumn("stage", F.lit("in force"))
    return judged.unionByName(now).withColumns(
        {"retrained": F.lit(done.retrained), "version": F.lit(done.version)}
    )
