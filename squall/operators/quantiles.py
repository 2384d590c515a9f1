"""Exact quantiles with linear interpolation, for groups of any size.

Spark's `percentile` keeps every distinct value of a group in one task. That is fine up to a
bounded group size, which is checked. Beyond it the wanted order statistics are bracketed by
repeated histograms: each pass counts rows per bin (combined map-side, so a hot key costs no more
than any other), keeps the bin that holds the wanted rank, and the next pass bins only that one.
"""

import sys
from collections.abc import Sequence
from itertools import chain

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from squall.operators.columns import quoted
from squall.operators.stats import column_stats, figure, struct, to_wide, unstacked
from squall.storage import materialise

MAX_VALUES_IN_TASK = 2_000_000
BINS = 1024
LARGEST = sys.float_info.max


def quantile_stats(
    df: DataFrame,
    cols: Sequence[str],
    probs: Sequence[float],
    keys: Sequence[str] = (),
    *,
    method: str = "exact",
    accuracy: int = 10_000,
    max_values_in_task: int = MAX_VALUES_IN_TASK,
    bins: int = BINS,
) -> DataFrame:
    """Per key, `STATS.<col>` = struct of `n`, `min`, `max` and `q` (array in the order of `probs`).

    A key without any value has `n` 0 and nulls, whatever its size. Infinite values are values like any
    other, and NaN is the largest of all.

    `method="approx"` uses `approx_percentile` (no interpolation, rank error 1/accuracy).
    """
    if method == "approx":
        return _grouped(df, cols, keys, f"approx_percentile({{x}}, {_array(probs)}, {accuracy})")
    if method != "exact":
        raise ValueError(f"unknown quantile method: {method}")
    rows = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    if rows * len(cols) <= max_values_in_task:
        return _grouped(df, cols, keys, f"percentile({{x}}, {_array(probs)})")
    return _bracketed(df, cols, probs, keys, bins)


def quantiles(
    df: DataFrame, cols: Sequence[str], probs: Sequence[float], keys: Sequence[str] = (), **options
) -> DataFrame:
    """Long form: one row `(keys…, column, p, value)` per quantile."""
    stats = quantile_stats(df, cols, probs, keys, **options)
    cells = [
        struct({"column": f"'{c}'", "p": f"{float(p)}D", "value": figure(c, f"q[{i}]")})
        for c in cols
        for i, p in enumerate(probs)
    ]
    return stats.selectExpr(*map(quoted, keys), unstacked(cells))


def _array(probs: Sequence[float]) -> str:
    return f"array({', '.join(f'{float(p)}D' for p in probs)})"


def _grouped(df: DataFrame, cols, keys, quantile: str) -> DataFrame:
    figures = {
        "n": "count({x})",
        "min": "double(min({x}))",
        "max": "double(max({x}))",
        "q": f"cast({quantile} as array<double>)",
    }
    return column_stats(df, cols, figures, keys)


def _bracketed(df: DataFrame, cols, probs, keys, bins: int) -> DataFrame:
    by = [*keys, "column"]
    cells = [struct({"column": f"'{c}'", "v": f"double({quoted(c)})"}) for c in cols]
    values = df.selectExpr(*map(quoted, keys), unstacked(cells))
    totals = materialise(
        values.groupBy(*by).agg(
            F.count("v").alias("n"), F.min("v").alias("min"), F.max("v").alias("max")
        ),
        "quantile-totals",
    )
    values = values.filter("v is not null")

    # Every quantile needs the order statistics just below and just above its position.
    position = [F.lit(float(p)) * (F.col("n") - 1) for p in probs]
    ranks = F.array_distinct(
        F.array(*chain.from_iterable((F.floor(x), F.ceil(x)) for x in position))
    )
    targets = materialise(
        totals.filter("n > 0").select(
            *by,
            F.explode(ranks).alias("rank"),
            F.col("min").alias("lo"),
            F.col("max").alias("hi"),
            F.lit(0).cast("long").alias("below"),
        ),
        "quantile-targets",
    )
    found = []
    while True:
        found.append(targets.filter("lo = hi").select(*by, "rank", F.col("lo").alias("v")))
        pending = targets.filter("lo < hi")
        if pending.isEmpty():
            break
        targets = materialise(_narrow(values, pending, by, bins), "quantile-targets")
        if len(found) == 1:
            # One pass later only a sliver of the rows can still matter; stop rescanning the rest.
            values = materialise(_inside(values, targets, by), "quantile-candidates")

    order_stats = found[0]
    for part in found[1:]:
        order_stats = order_stats.unionByName(part)
    by_rank = order_stats.groupBy(*by).agg(
        F.map_from_entries(F.collect_list(F.struct("rank", "v"))).alias("at")
    )
    solved = totals.join(by_rank, by, "left")
    q = F.when(F.col("n") > 0, F.array(*[_between(F.col("at"), x) for x in position]))
    return to_wide(solved.withColumn("q", q), cols, ["n", "min", "max", "q"], keys)


def _inside(values: DataFrame, targets: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows that lie in at least one bracket that is still open."""
    spans = targets.filter("lo < hi").groupBy(*by).agg(
        F.collect_set(F.struct("lo", "hi")).alias("spans")
    )
    hit = F.exists("spans", lambda s: F.col("v").between(s["lo"], s["hi"]))
    return values.join(spans, list(by)).filter(hit).drop("spans")


def _narrow(values: DataFrame, pending: DataFrame, by: Sequence[str], bins: int) -> DataFrame:
    """Replace each bracket `[lo, hi]` by the extent of the bin that holds its rank."""
    target = [*by, "lo", "hi"]
    brackets = pending.groupBy(*target).agg(F.first("below").alias("below"))
    bin_no = _bin("v", "lo", "hi", bins)
    counts = (
        values.join(brackets, list(by))
        .filter("v between lo and hi")
        .groupBy(*target, "below", bin_no.alias("bin"))
        .agg(F.count("v").alias("n"), F.min("v").alias("bin_lo"), F.max("v").alias("bin_hi"))
    )
    so_far = Window.partitionBy(*target).orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    cells = counts.select(
        *target, "bin_lo", "bin_hi", "n", (F.col("below") + F.sum("n").over(so_far)).alias("upto")
    )
    return (
        pending.drop("below")
        .join(cells, target)
        .filter("rank < upto and rank >= upto - n")
        .select(*by, "rank", F.col("bin_lo").alias("lo"), F.col("bin_hi").alias("hi"),
                (F.col("upto") - F.col("n")).alias("below"))
    )


def _bin(v: str, lo: str, hi: str, bins: int) -> Column:
    """Bin of `v` in `[lo, hi]`, lo < hi; the two ends never share one, so every pass narrows.

    Infinities and NaN have bins of their own. Halves keep the width of the finite rest from overflowing.
    """
    low, high = F.greatest(F.lit(-LARGEST), lo), F.least(F.lit(LARGEST), hi)
    width, past = high - low, F.col(v) - low
    halves = (F.col(v) / 2 - low / 2) / (high / 2 - low / 2)
    share = F.when(high <= low, 0.0).when(width <= LARGEST, past / width).otherwise(halves)
    return (
        F.when(F.isnan(v), bins + 1)
        .when(F.col(v) > LARGEST, bins)
        .when(F.col(v) < -LARGEST, -1)
        .otherwise(F.least(F.floor(share * bins), F.lit(bins - 1)))
    )


def _between(at: Column, position: Column) -> Column:
    low, high = F.floor(position), F.ceil(position)
    low_value, high_value = at[low], at[high]
    return F.when(low == high, low_value).otherwise(
        (high - position) * low_value + (position - low) * high_value
    )
