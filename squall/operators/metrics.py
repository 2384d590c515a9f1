"""Prediction errors and the gate on them."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A model is retrained above this rmse or below this r2.
DAILY_THRESHOLDS = {"rmse": 5.0, "r2": 0.8}
HOURLY_THRESHOLDS = {"rmse": 5.0, "r2": 0.08}


def error_metrics(
    df: DataFrame, pairs: dict[str, tuple[str, str]], keys: Sequence[str] = ()
) -> DataFrame:
    """`(keys…, target, n, mae, rmse, r2, bias)` for `{target: (actual, predicted)}`.

    All targets share one pass. `bias` is mean(predicted - actual). A constant actual has r2 1 for
    a perfect prediction and 0 otherwise.
    """

    def figures(target: str, actual: str, predicted: str) -> Column:
        y = F.when(F.col(predicted).isNotNull(), F.col(actual).cast("double"))
        error = F.col(predicted).cast("double") - F.col(actual).cast("double")
        return F.struct(
            F.lit(target).alias("target"),
            F.count(error).alias("n"),
            F.avg(F.abs(error)).alias("mae"),
            F.avg(error * error).alias("mse"),
            F.var_pop(y).alias("spread"),
            F.avg(error).alias("bias"),
        )

    sums = df.groupBy(*keys).agg(F.array(*[figures(t, *p) for t, p in pairs.items()]).alias("m"))
    rows = sums.select(*keys, F.inline("m"))
    constant = F.when(F.col("mse") == 0, 1.0).when(F.col("mse").isNotNull(), 0.0)
    r2 = F.when(F.col("spread") > 0, 1 - F.try_divide("mse", "spread")).otherwise(constant)
    return rows.select(
        *keys, "target", "n", "mae", F.sqrt("mse").alias("rmse"), r2.alias("r2"), "bias"
    )


def monitor(metrics: DataFrame, thresholds: dict[str, float]) -> DataFrame:
    """Metrics with a `breach` flag per target and `retrain_needed` if any target breaches."""
    breach = F.coalesce(
        (F.col("rmse") > thresholds["rmse"]) | (F.col("r2") < thresholds["r2"]), F.lit(False)
    )
    flagged = metrics.withColumn("breach", breach)
    return flagged.withColumn("retrain_needed", flagged.agg(F.bool_or("breach")).scalar())


def retrain_needed(monitored: DataFrame) -> bool:
    """The gate as one boolean on the driver."""
    return bool(monitored.agg(F.bool_or("breach")).first()[0])
