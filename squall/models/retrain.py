"""Monitoring and the retraining gate."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from squall.models.analysis import evaluate
from squall.models.predictors import Family, Predictor, tree_family
from squall.operators.metrics import monitor, retrain_needed
from squall.storage import materialise
from squall.versions import Versions


def monitor_models(
    model: Predictor,
    df: DataFrame,
    thresholds: dict[str, float],
    ts: str | None = None,
    since: str | None = None,
) -> DataFrame:
    """Metrics per target with breach flags; `since` limits them to rows the model has not seen."""
    if since is not None:
        df = df.filter(F.col(ts) >= F.lit(since).cast(df.schema[ts].dataType))
    return monitor(materialise(evaluate(model, df), "metrics"), thresholds)


def retrain_if_degraded(
    model: Predictor,
    df: DataFrame,
    monitored: DataFrame,
    features: Sequence[str],
    folder: str | Versions,
    family: Family | None = None,
    **training,
) -> tuple[Predictor, bool]:
    """Train new models on `df` and save them if any target breaches its thresholds.

    Under a path they are simply written. Under `Versions` they become the next version, in force once it
    is written whole: if training or writing fails, the old version stays in force. `df` should hold newer
    rows than the model was trained on; the same rows and seed give the same model again.
    """
    if not retrain_needed(monitored):
        return model, False
    fresh = (family or tree_family(**training)).fit(df, features, model.targets)
    if isinstance(folder, Versions):
        folder.publish(fresh.save)
    else:
        fresh.save(folder)
    return fresh, True


def models_in_force(
    versions: Versions, family: Family, targets: Sequence[str], features: Sequence[str]
) -> Predictor | None:
    """The models of the version in force, if any was published."""
    version = versions.current()
    return None if version is None else family.load(version.path, targets, features)
