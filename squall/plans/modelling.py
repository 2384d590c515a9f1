"""The whole way of one model set: extract, train, save, analyse, forecast, monitor, retrain.

The steps run one after the other, each as soon as what it reads is written, and every step stores its table.
"""

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession
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
    train_test_split,
    training_extract,
)
from squall.models.forecast import predict_single_date
from squall.models.predictors import Family, Predictor, tree_family
from squall.models.retrain import monitor_models, retrain_if_degraded
from squall.operators.checks import write_checked
from squall.operators.metrics import DAILY_THRESHOLDS, HOURLY_THRESHOLDS, monitor
from squall.sources.tables import write_sensitivity
from squall.versions import Versions

CELLS = 50  # a side of the actual/predicted chart


@dataclass
class Modelled:
    """Models in force after a run, and the tables the run stored."""

    models: Predictor
    versions: Versions
    retrained: bool
    tables: dict[str, DataFrame]
    rows: dict[str, int]

    @property
    def version(self) -> int:
        return self.versions.current().number

    def __getattr__(self, name: str) -> DataFrame:
        """`bias`, `chart`, `sensitivity`, `holdout`, `today`, `monitored`: stored tables by their name."""
        try:
            return self.__dict__["tables"][name]
        except KeyError:
            raise AttributeError(name) from None

    @cached_property
    def manifest(self) -> DataFrame:
        """`(artifact, rows)` of every stored table."""
        spark = next(iter(self.tables.values())).sparkSession
        return spark.createDataFrame(sorted(self.rows.items()), "artifact string, rows bigint")


@dataclass
class _Run:
    """Where a run stores its tables."""

    spark: SparkSession
    folder: str
    tables: dict[str, DataFrame] = field(default_factory=dict)
    rows: dict[str, int] = field(default_factory=dict)

    def store(self, name: str, table: DataFrame) -> DataFrame:
        path = f"{self.folder}/{name}"
        self.rows[name] = write_checked(table, path)["rows"]
        self.tables[name] = self.spark.read.schema(table.schema).parquet(path)
        return self.tables[name]


def model_daily(
    df: DataFrame,
    folder: str,
    as_of: str,
    identity: Sequence[str],
    keys: Sequence[str] = (),
    thresholds: dict[str, float] = DAILY_THRESHOLDS,
    **options,
) -> Modelled:
    """Daily models, put in force before they are analysed; see `run_models` for the options."""
    extract = _extract(df, "date", [*identity, *keys, *DAILY_TARGETS], hourly=False)
    return run_models(
        extract, folder, "date", identity, DAILY_FEATURES, DAILY_TARGETS, DAILY_PERTURBATIONS, thresholds,
        as_of=as_of, keys=keys, **options,
    )


def model_hourly(
    df: DataFrame,
    folder: str,
    identity: Sequence[str],
    thresholds: dict[str, float] = HOURLY_THRESHOLDS,
    **options,
) -> Modelled:
    """Hourly models, analysed before they are put in force."""
    extract = _extract(df, "datetime", [*identity, *HOURLY_TARGETS], hourly=True)
    return run_models(
        extract, folder, "datetime", identity, HOURLY_FEATURES, HOURLY_TARGETS, HOURLY_PERTURBATIONS,
        thresholds, analyse_first=True, **options,
    )


def _extract(df: DataFrame, ts: str, cols: Sequence[str], hourly: bool) -> DataFrame:
    """Only the columns the model steps read are carried into the extract."""
    return training_extract(df.select(*dict.fromkeys([ts, *cols])), ts, hourly)


def run_models(
    extract: DataFrame,
    folder: str,
    ts: str,
    identity: Sequence[str],
    features: Sequence[str],
    targets: Sequence[str],
    perturbations: dict[str, Sequence[int]],
    thresholds: dict[str, float],
    *,
    as_of: str | None = None,
    keys: Sequence[str] = (),
    since: str | None = None,
    family: Family | None = None,
    analyse_first: bool = False,
    **training,
) -> Modelled:
    """Train on the training part of `extract`, analyse, forecast `as_of`, and retrain if the gate says so.

    Models are versions under `folder/models`; the tables of the run lie beside its version. With `since` the
    first models see only earlier rows, the gate judges them on the rows from then on, and new models
    learn from the training part of all rows. Without it the gate judges on all rows, as
    does the bias report, and retraining sees nothing new.
    """
    spark, family = extract.sparkSession, family or tree_family(**training)
    versions = Versions(spark, f"{folder}/models")
    before = versions.current()
    run = _Run(spark, f"{folder}/runs/{1 if before is None else before.number + 1}")
    train, test = train_test_split(extract, identity)
    start = None if since is None else F.lit(since).cast(extract.schema[ts].dataType)
    old_rows = train if start is None else train.filter(F.col(ts) < start)
    models = family.fit(old_rows, features, targets)

    def analyse() -> None:
        metrics, charts = bias_analysis(models, extract, CELLS)
        run.store("bias", metrics)
        cells = [c.select(F.lit(t).alias("target"), *c.columns) for t, c in charts.items()]
        run.store("chart", reduce(DataFrame.unionByName, cells))
        sensitivity = run.store("sensitivity", sensitivity_analysis(models, extract, features, perturbations))
        write_sensitivity(sensitivity, f"{run.folder}/sensitivity-by-target")
        run.store("holdout", evaluate(models, test))

    if analyse_first:
        analyse()
        versions.publish(models.save)
    else:
        versions.publish(models.save)
        analyse()
    if as_of is not None:
        run.store("today", predict_single_date(models, extract.select(*keys).distinct(), as_of))
    if since is None:
        judged = monitor(run.tables["bias"], thresholds)
    else:
        judged = monitor_models(models, extract, thresholds, ts, since)
    monitored = run.store("monitored", judged)
    models, retrained = retrain_if_degraded(models, train, monitored, features, versions, family)
    return Modelled(models, versions, retrained, run.tables, run.rows)
