"""Outlier clipping and min-max scaling."""

from collections.abc import Sequence

from pyspark.sql import DataFrame

from squall.operators.columns import quoted, replaced
from squall.operators.quantiles import quantile_stats
from squall.operators.stats import (
    STATS,
    attach,
    column_stats,
    figure,
    global_min_max,
    struct,
    to_long,
    to_wide,
)
from squall.storage import materialise

FENCE = 1.5
DIGITS = 3


def iqr_stats(
    df: DataFrame,
    cols: Sequence[str],
    keys: Sequence[str] = (),
    unclipped: Sequence[str] = (),
    **options,
) -> DataFrame:
    """Per key and column: quartiles, fences `lo`/`hi`, and the extent `min`/`max` after clipping.

    The fences of an `unclipped` column are its extremes.
    """
    stats = quantile_stats(df, cols, [0.25, 0.75], keys, **options)

    def fences(c: str) -> str:
        q1, q3 = figure(c, "q[0]"), figure(c, "q[1]")
        low, high = figure(c, "min"), figure(c, "max")
        lo, hi = f"{q1} - {FENCE}D * ({q3} - {q1})", f"{q3} + {FENCE}D * ({q3} - {q1})"
        if c in unclipped:
            lo, hi = low, high
        return struct(
            {
                "q1": q1, "q3": q3, "lo": lo, "hi": hi,
                "min": clipped(low, lo, hi), "max": clipped(high, lo, hi),
            }
        )

    return stats.selectExpr(*map(quoted, keys), f"{struct({c: fences(c) for c in cols})} as {STATS}")


def iqr_bounds(
    df: DataFrame, cols: Sequence[str], keys: Sequence[str] = (), **options
) -> DataFrame:
    stats = iqr_stats(df, cols, keys, **options)
    return to_long(stats, cols, ["q1", "q3", "lo", "hi"], keys)


def clipped(x: str, lo: str, hi: str) -> str:
    """SQL: `x` limited to `[lo, hi]`; null stays null (`least`/`greatest` would skip it)."""
    return f"case when {x} is not null then greatest({lo}, least({hi}, {x})) end"


def scaled(x: str, lo: str, hi: str, digits: int = DIGITS) -> str:
    """SQL: `(x - lo) / (hi - lo)`, ties rounded to even; null for a constant column."""
    unit = 10**digits
    return f"rint(try_divide({x} - {lo}, {hi} - {lo}) * {unit}) / {unit}"


def unscaled(value: str, lo: str, hi: str) -> str:
    """SQL: back from `[0, 1]` to `[lo, hi]`."""
    return f"{value} * ({hi} - {lo}) + {lo}"


def iqr_clip(
    df: DataFrame, cols: Sequence[str], keys: Sequence[str] = (), **options
) -> DataFrame:
    """Limit every column to its fences; no row is removed."""
    joined = attach(df, iqr_stats(df, cols, keys, **options), keys)
    return replaced(
        df, joined, {c: clipped(quoted(c), figure(c, "lo"), figure(c, "hi")) for c in cols}
    )


def minmax_fit(df: DataFrame, cols: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Scaler table `(keys…, column, min, max)` of those `cols` that the table has."""
    return global_min_max(df, [c for c in cols if c in df.columns], keys)


def minmax_scale(
    df: DataFrame,
    cols: Sequence[str],
    keys: Sequence[str] = (),
    scaler: DataFrame | None = None,
    digits: int = DIGITS,
) -> DataFrame:
    """Scale with a stored scaler table, or with the extent of `df` itself."""
    if scaler is None:
        extent = column_stats(df, cols, {"min": "min({x})", "max": "max({x})"}, keys)
        joined = attach(df, extent, keys)
    else:
        joined = _with_scaler(df, scaler, cols, keys)
    return replaced(
        df, joined, {c: scaled(quoted(c), figure(c, "min"), figure(c, "max"), digits) for c in cols}
    )


def minmax_inverse(
    df: DataFrame, scaler: DataFrame, cols: Sequence[str], keys: Sequence[str] = ()
) -> DataFrame:
    """Back to original units with a stored scaler table."""
    joined = _with_scaler(df, scaler, cols, keys)
    return replaced(
        df, joined, {c: unscaled(quoted(c), figure(c, "min"), figure(c, "max")) for c in cols}
    )


def clip_and_scale(
    df: DataFrame,
    cols: Sequence[str],
    keys: Sequence[str] = (),
    *,
    unclipped: Sequence[str] = (),
    scale: bool = True,
    digits: int = DIGITS,
    **options,
) -> tuple[DataFrame, DataFrame]:
    """`iqr_clip`, then `minmax_scale`, from one set of statistics.

    Clipping is monotone, so the extent after clipping follows from the extent before it and no
    second pass over the rows is needed. Returns the rows and the scaler table; with `scale=False`
    the rows are only clipped. `unclipped` columns are scaled without clipping.
    """
    stats = materialise(iqr_stats(df, cols, keys, unclipped, **options), "clip-stats")
    joined = attach(df, stats, keys, written=True)

    def value(c: str) -> str:
        x = quoted(c)
        if c not in unclipped:
            x = clipped(x, figure(c, "lo"), figure(c, "hi"))
        return scaled(x, figure(c, "min"), figure(c, "max"), digits) if scale else x

    scaler = to_long(stats, cols, ["min", "max"], keys)
    return replaced(df, joined, {c: value(c) for c in cols}), scaler


def _with_scaler(df: DataFrame, scaler: DataFrame, cols, keys) -> DataFrame:
    return attach(df, to_wide(scaler, cols, ["min", "max"], keys), keys)
