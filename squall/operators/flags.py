"""Flags against quantiles of the column itself."""

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame

from squall.operators.columns import quoted
from squall.operators.quantiles import quantile_stats
from squall.operators.stats import attach, figure


class QuantileFlag(NamedTuple):
    column: str
    p: float
    above: bool = True


# What counts as a hot, a cold and a very wet day.
DAILY_QUANTILE_FLAGS = {
    "is_hot_day": QuantileFlag("temperature_2m_max", 0.9),
    "is_cold_day": QuantileFlag("temperature_2m_min", 0.1, above=False),
    "is_heavy_precipitation": QuantileFlag("precipitation_sum", 0.95),
}


def quantile_flags(
    df: DataFrame,
    flags: dict[str, QuantileFlag] = DAILY_QUANTILE_FLAGS,
    keys: Sequence[str] = (),
    **options,
) -> DataFrame:
    """Add a 0/1 column per flag; all quantiles come from one pass."""
    cols = sorted({f.column for f in flags.values()})
    probs = sorted({f.p for f in flags.values()})
    joined = attach(df, quantile_stats(df, cols, probs, keys, **options), keys)

    def test(f: QuantileFlag) -> str:
        limit = figure(f.column, f"q[{probs.index(f.p)}]")
        return f"int(coalesce({quoted(f.column)} {'>' if f.above else '<'} {limit}, false))"

    added = [f"{test(f)} as {quoted(name)}" for name, f in flags.items()]
    return joined.selectExpr(*[quoted(c) for c in df.columns if c not in flags], *added)
