"""The best single split of the training combinations, found by prefix sums.

A regression tree of depth one cuts one feature at one threshold so that squared errors on both sides add up to the
least. On combinations with counts and means this is a sum and two prefix sums per feature value: what a
boosted model's first split must equal.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from squall.storage import materialise

TIE = 1e-9  # gains nearer to the best than this share of it are equal to it


def split_candidates(combos: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """`(feature, place, threshold, left_mean, right_mean, gain)` of every threshold between two values.

    `combos` has per target a mean and a count (see `combinations`). `gain` is the variance that a cut takes
    away; the threshold lies half-way between neighbouring values. Values of a feature are calendar
    parts, so a window holds few rows.
    """
    n, mean = F.col(f"{target}__n"), F.col(f"{target}__mean")
    known = combos.filter(n > 0)
    values = known.select(
        n.alias("n"),
        (mean * n).alias("s"),
        F.posexplode(F.array(*[F.col(f).cast("double") for f in features])).alias("place", "value"),
    )
    sums = values.groupBy("place", "value").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    order = Window.partitionBy("place").orderBy("value")
    left = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    right = order.rowsBetween(1, Window.unboundedFollowing)
    cuts = sums.select(
        "place",
        ((F.col("value") + F.lead("value").over(order)) / 2).alias("threshold"),
        F.sum("n").over(left).alias("n_left"),
        F.sum("s").over(left).alias("s_left"),
        F.sum("n").over(right).alias("n_right"),
        F.sum("s").over(right).alias("s_right"),
    ).filter("threshold is not null")
    left_mean, right_mean = F.col("s_left") / F.col("n_left"), F.col("s_right") / F.col("n_right")
    both = F.col("n_left") + F.col("n_right")
    apart = left_mean - right_mean
    return cuts.select(
        F.element_at(F.array(*map(F.lit, features)), F.col("place") + 1).alias("feature"),
        "place",
        "threshold",
        left_mean.alias("left_mean"),
        right_mean.alias("right_mean"),
        (F.col("n_left") * F.col("n_right") / (both * both) * apart * apart).alias("gain"),
    )


def best_split(combos: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """`(target, feature, threshold, left_mean, right_mean, gain)`: one row, or none without two values.

    Of equal gains the first feature as listed wins, then the lower threshold. Features that cut the rows
    alike differ by rounding only, so gains within a billionth of the best count as equal.
    """
    cuts = materialise(split_candidates(combos, features, target), "cuts")
    most = cuts.agg(F.max("gain")).scalar()
    best = F.min_by(
        F.struct("feature", "threshold", "left_mean", "right_mean", "gain"), F.struct("place", "threshold")
    )
    one = cuts.filter(F.col("gain") >= most * (1 - TIE)).agg(best.alias("best")).filter("best is not null")
    return one.select(F.lit(target).alias("target"), "best.*")
