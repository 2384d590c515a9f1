"""Filling missing values."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from squall.operators.blocks import (
    BLOCK,
    MAX_BLOCK_ROWS,
    epoch_seconds,
    over_block,
    over_summaries,
    position,
    with_block,
)
from squall.operators.columns import non_null_counts, quoted, replaced
from squall.operators.stats import attach, column_stats, figure

# Which rule fills which hourly column, by exact name, then by part of the name.
ZERO_FILLED = ("precipitation", "rain", "showers", "snowfall")
INTERPOLATED_PARTS = ("temperature", "humidity", "pressure")


def ffill(
    df: DataFrame,
    cols: Sequence[str],
    *,
    ts: str,
    keys: Sequence[str] = (),
    ties: Sequence[str] = (),
    width: int | None = None,
    max_rows: int = MAX_BLOCK_ROWS,
) -> DataFrame:
    """Last known value of each column; leading nulls stay."""
    blocked = with_block(df, ts, keys, ties, width, max_rows)
    carry = _carried(blocked, cols, ts, keys, ties, {c: quoted(c) for c in cols})
    here = over_block(ts, keys, ties)
    filled = replaced(
        blocked, blocked, {c: f"last({quoted(c)}, true) {here}" for c in cols}
    ).join(carry, [*keys, BLOCK], "left")
    return replaced(
        df, filled, {c: f"coalesce({quoted(c)}, {quoted(c + '__carry')})" for c in cols}
    )


def interpolate_time(
    df: DataFrame,
    cols: Sequence[str],
    *,
    ts: str,
    keys: Sequence[str] = (),
    ties: Sequence[str] = (),
    width: int | None = None,
    max_rows: int = MAX_BLOCK_ROWS,
) -> DataFrame:
    """Linear interpolation weighted by time.

    Leading nulls stay null; after the last known value that value is kept.
    """
    blocked = with_block(df, ts, keys, ties, width, max_rows).withColumn("__at", _seconds(df, ts))
    points = {c: f"named_struct('t', __at, 'v', double({quoted(c)}))" for c in cols}
    carry = _carried(blocked, cols, ts, keys, ties, points, both_ways=True)
    forward, backward = over_block(ts, keys, ties), over_block(ts, keys, ties, reverse=True)
    known = {c: f"case when {quoted(c)} is not null then {points[c]} end" for c in cols}
    near = blocked.selectExpr(
        "*",
        *[f"last({known[c]}, true) {forward} as {quoted(c + '__p')}" for c in cols],
        *[f"last({known[c]}, true) {backward} as {quoted(c + '__n')}" for c in cols],
    )
    near = near.join(carry, [*keys, BLOCK], "left")

    def value(c: str) -> str:
        p = f"coalesce({quoted(c + '__p')}, {quoted(c + '__carry')})"
        n = f"coalesce({quoted(c + '__n')}, {quoted(c + '__next')})"
        share = f"try_divide(__at - {p}.t, {n}.t - {p}.t)"
        line = f"{p}.v + ({n}.v - {p}.v) * {share}"
        return f"coalesce(double({quoted(c)}), {line}, {p}.v)"

    return replaced(df, near, {c: value(c) for c in cols})


def fill_zero(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.fillna(0, subset=list(cols))


def fill_mean(df: DataFrame, cols: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Mean of the column (per key); a column without any value stays null."""
    if not cols:
        return df
    joined = attach(df, column_stats(df, cols, {"mean": "avg({x})"}, keys), keys)
    return replaced(df, joined, {c: f"coalesce({quoted(c)}, {figure(c, 'mean')})" for c in cols})


def fill_rules(cols: Sequence[str]) -> dict[str, str]:
    """Rule per column name: `zero`, `interpolate` or `mean`."""

    def rule(c: str) -> str:
        if c in ZERO_FILLED:
            return "zero"
        return "interpolate" if any(part in c for part in INTERPOLATED_PARTS) else "mean"

    return {c: rule(c) for c in cols}


def impute_by_rule(
    df: DataFrame,
    cols: Sequence[str],
    *,
    ts: str,
    keys: Sequence[str] = (),
    ties: Sequence[str] = (),
    width: int | None = None,
    max_rows: int = MAX_BLOCK_ROWS,
) -> DataFrame:
    """Fill every column by the rule its name selects; complete and empty columns are left alone."""
    counts = non_null_counts(df.withColumn("__row", F.lit(1)), ["__row", *cols])
    rules = fill_rules([c for c in cols if 0 < counts[c] < counts["__row"]])
    # A column without any value: 0 where the rule says so, otherwise it stays null.
    rules |= {c: "zero" for c in cols if counts[c] == 0 and c in ZERO_FILLED}
    chosen = {r: [c for c, rule in rules.items() if rule == r] for r in ("zero", "mean", "interpolate")}
    filled = fill_mean(fill_zero(df, chosen["zero"]) if chosen["zero"] else df, chosen["mean"], keys)
    if not chosen["interpolate"]:
        return filled
    return interpolate_time(
        filled, chosen["interpolate"], ts=ts, keys=keys, ties=ties, width=width, max_rows=max_rows
    )


def _carried(
    blocked: DataFrame,
    cols: Sequence[str],
    ts: str,
    keys: Sequence[str],
    ties: Sequence[str],
    values: dict[str, str],
    both_ways: bool = False,
) -> DataFrame:
    """Per block and column the nearest known value in the blocks before it, `<col>__carry`.

    With `both_ways` also the nearest in the blocks after it, `<col>__next`. One aggregate finds the
    values at both ends of every block; the windows only see those.
    """
    at = position(ts, ties)

    def edge(pick: str, c: str, suffix: str):
        known = f"case when {quoted(c)} is not null then {at} end"
        return F.expr(f"{pick}({values[c]}, {known})").alias(c + suffix)

    ends = [edge("max_by", c, "__last") for c in cols]
    if both_ways:
        ends += [edge("min_by", c, "__first") for c in cols]
    past, future = over_summaries(keys), over_summaries(keys, reverse=True)
    carried = [
        f"last({quoted(c + '__last')}, true) {past} as {quoted(c + '__carry')}" for c in cols
    ]
    if both_ways:
        carried += [
            f"last({quoted(c + '__first')}, true) {future} as {quoted(c + '__next')}" for c in cols
        ]
    summary = blocked.groupBy(*keys, BLOCK).agg(*ends)
    return summary.selectExpr(*map(quoted, [*keys, BLOCK]), *carried)


def _seconds(df: DataFrame, ts: str) -> Column:
    """Time as a number for interpolation, to the microsecond for timestamps."""
    if isinstance(df.schema[ts].dataType, T.TimestampType):
        return F.unix_micros(ts) / F.lit(1e6)
    return epoch_seconds(df, ts).cast("double")
