"""Bias, sensitivity and hold-out analysis."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from squall.models.features import combinations
from squall.models.predictors import Predictor, predict_batch, prediction
from squall.operators.eda import scatter_cells
from squall.operators.metrics import error_metrics

# Which feature is set to which constants.
DAILY_PERTURBATIONS = {
    "month": (1, 6, 12),
    "day_of_year": (1, 182, 365),
    "week_of_year": (1, 26, 52),
}
HOURLY_PERTURBATIONS = {
    "hour": (0, 12, 23),
    "day_of_year": (1, 182, 365),
    "month": (1, 6, 12),
}


def evaluate(model: Predictor, df: DataFrame) -> DataFrame:
    """Error metrics of every target on the rows of `df`."""
    pairs = {t: (t, prediction(t)) for t in model.targets}
    return error_metrics(predict_batch(model, df), pairs)


def bias_analysis(
    model: Predictor, df: DataFrame, cells: int = 50
) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Metrics per target, and per target the cells of its actual/predicted chart."""
    scored = predict_batch(model, df)
    metrics = error_metrics(scored, {t: (t, prediction(t)) for t in model.targets})
    return metrics, {t: scatter_cells(scored, t, prediction(t), cells) for t in model.targets}


def sensitivity_analysis(
    model: Predictor,
    df: DataFrame,
    features: Sequence[str],
    perturbations: dict[str, Sequence[int]],
) -> DataFrame:
    """`(target, feature, value, average_prediction)`: mean prediction with one feature fixed.

    Works on the distinct feature rows and their counts; each is repeated once per perturbation.
    """
    steps = [
        F.struct(F.lit(f).alias("feature"), F.lit(v).alias("value"))
        for f, values in perturbations.items()
        for v in values
    ]
    varied = combinations(df, features).select("*", F.explode(F.array(*steps)).alias("step"))
    fixed = {
        f: F.when(F.col("step.feature") == f, F.col("step.value")).otherwise(F.col(f))
        for f in features
    }
    cases = varied.withColumns(fixed).groupBy("step", *features).agg(F.sum("rows").alias("rows"))
    scored = model.score(cases)
    means = scored.groupBy("step").agg(
        F.array(
            *[
                F.struct(
                    F.lit(t).alias("target"),
                    F.try_divide(
                        F.sum(F.col(prediction(t)) * F.col("rows")), F.sum("rows")
                    ).alias("average_prediction"),
                )
                for t in model.targets
            ]
        ).alias("means")
    )
    return means.select("step.feature", "step.value", F.inline("means")).select(
        "target", "feature", "value", "average_prediction"
    )
