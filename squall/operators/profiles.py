"""Column profiles that are stored run by run, merged and compared.

A partial profile has one row per column: counts, mean and sum of squared deviations, extremes, and a
quantile sketch of bounded size. Partial profiles of parts add up to that of the whole, so a new part needs no second
look at the old ones.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from squall.operators.stats import column_stats, figure, struct, unstacked

SKETCH_SIZE = 800  # of a KLL sketch: ranks are right within about 0.3 %

_FIGURES = {
    "rows": "count(1)",
    "count": "count({x})",
    "mean": "avg({x})",
    "m2": "var_pop({x}) * count({x})",
    "min": "min(double({x}))",
    "max": "max(double({x}))",
    "sketch": f"kll_sketch_agg_double(double({{x}}), {SKETCH_SIZE})",
}


def partial_profile(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """`(column, type, rows, count, mean, m2, min, max, sketch)` for each of the numeric `cols`: one pass.

    A column without values has nulls for its figures. Missing is null; NaN is not expected here.
    """
    stats = column_stats(df, cols, _FIGURES)

    def row(c: str) -> str:
        kind = df.schema[c].dataType.simpleString()
        return struct({"column": f"'{c}'", "type": f"'{kind}'"} | {n: figure(c, n) for n in _FIGURES})

    return stats.selectExpr(unstacked([row(c) for c in cols]))


def merge_profiles(parts: DataFrame) -> DataFrame:
    """Partial profiles of several parts, added up by column and type.

    Squared deviations move to the common mean: those inside the parts, and those of the parts' means, each
    from the first part's mean, which keeps large means from swallowing them.
    """
    seen = F.col("count") > 0
    base = parts.filter(seen).groupBy("column", "type").agg(F.min("mean").alias("base"))
    near = F.col("mean") - F.col("base")
    sums = parts.join(base, ["column", "type"], "left").groupBy("column", "type").agg(
        F.sum("rows").alias("rows"),
        F.sum("count").alias("count"),
        F.first("base", ignorenulls=True).alias("base"),
        F.sum(near * F.col("count")).alias("s1"),
        F.sum(F.col("m2") + near * near * F.col("count")).alias("s2"),
        F.min("min").alias("min"),
        F.max("max").alias("max"),
        F.kll_merge_agg_double("sketch").alias("sketch"),
    )
    return sums.select(
        "column",
        "type",
        "rows",
        "count",
        (F.col("base") + F.try_divide("s1", "count")).alias("mean"),
        F.greatest(F.col("s2") - F.try_divide(F.col("s1") * F.col("s1"), "count"), F.lit(0.0)).alias("m2"),
        "min",
        "max",
        "sketch",
    )


def _quantile(q: float) -> Column:
    """Null for a column without values: an empty sketch has no quantiles."""
    return F.when(F.col("count") > 0, F.kll_sketch_get_quantile_double("sketch", F.lit(q)))


def profile_figures(partial: DataFrame) -> DataFrame:
    """`(column, type, rows, count, nulls, mean, std, min, q1, median, q3, max)` of a partial profile.

    Everything but the quartiles is exact; those come from the sketch.
    """
    return partial.select(
        "column",
        "type",
        "rows",
        "count",
        (F.col("rows") - F.col("count")).alias("nulls"),
        "mean",
        F.when(F.col("count") > 1, F.sqrt(F.col("m2") / (F.col("count") - 1))).alias("std"),
        "min",
        _quantile(0.25).alias("q1"),
        _quantile(0.5).alias("median"),
        _quantile(0.75).alias("q3"),
        "max",
    )


def compare_profiles(old: DataFrame, new: DataFrame) -> DataFrame:
    """What changed between two partial profiles, column by column.

    `(column, status, null_change, mean_shift, below, above)`: `status` as in `check_schema_match`, the change of
    the share of nulls, the change of the mean in old standard deviations, and how far the new values
    reach below the old minimum and above the old maximum. Figures are null where one side has no values.
    """

    def side(partial: DataFrame, name: str) -> DataFrame:
        figures = profile_figures(partial).withColumn("null_share", F.try_divide("nulls", "rows"))
        kept = ("type", "null_share", "mean", "std", "min", "max")
        return figures.select("column", F.struct(*kept).alias(name))

    both = side(old, "old").join(side(new, "new"), "column", "full")
    o, n = F.col("old"), F.col("new")
    status = (
        F.when(n.isNull(), "missing")
        .when(o.isNull(), "extra")
        .when(o["type"] != n["type"], "changed")
        .otherwise("same")
    )

    def beyond(distance: Column) -> Column:
        """`greatest` would skip a null."""
        return F.when(distance.isNotNull(), F.greatest(distance, F.lit(0.0)))

    return both.select(
        "column",
        status.alias("status"),
        (n["null_share"] - o["null_share"]).alias("null_change"),
        F.try_divide(n["mean"] - o["mean"], o["std"]).alias("mean_shift"),
        beyond(o["min"] - n["min"]).alias("below"),
        beyond(n["max"] - o["max"]).alias("above"),
    )


def share_below(partial: DataFrame, values: dict[str, float]) -> DataFrame:
    """`(column, value, share)`: about which share of a column's values lies at or below a value."""
    asked = partial.filter("count > 0").filter(F.col("column").isin(list(values)))
    value, share = F.lit(None).cast("double"), F.lit(None).cast("double")
    for c, v in values.items():
        mine = F.col("column") == c
        value = F.when(mine, F.lit(float(v))).otherwise(value)
        share = F.when(mine, F.kll_sketch_get_rank_double("sketch", F.lit(float(v)))).otherwise(share)
    return asked.select("column", value.alias("value"), share.alias("share"))
