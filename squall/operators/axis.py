"""Regular time axes."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from squall.operators.blocks import BLOCK, MAX_BLOCK_ROWS, over_block, over_summaries, with_block
from squall.operators.columns import quoted


def time_axis(start: Column, end: Column, step: Column) -> Column:
    """Half-open axis `[start, end)` as an array; empty if `end` is not after `start`."""
    axis = F.sequence(start, end, step)
    return F.when(end > start, F.filter(axis, lambda t: t < end)).otherwise(
        F.slice(F.array(start), 1, 0)
    )


def regular_grid(
    df: DataFrame,
    ts: str,
    step: str,
    keys: Sequence[str] = (),
    span: Column | None = None,
) -> DataFrame:
    """Every `(keys, ts)` between the first and last time of the table, missing rows as nulls.

    `step` is an interval such as `"1 hour"`. The span is common to all keys.
    """
    kind = df.schema[ts].dataType.simpleString()
    unit = F.expr(f"interval {step}")
    limits = df.agg(F.struct(F.min(ts).alias("lo"), F.max(ts).alias("hi")).alias("span"))
    stations = df.select(*keys).distinct() if keys else df.sparkSession.range(1).select()
    axis = (
        stations.withColumn("__span", limits.scalar() if span is None else span)
        .select(*keys, F.explode(F.sequence("__span.lo", "__span.hi", unit)).alias(ts))
        .withColumn(ts, F.col(ts).cast(kind))
    )
    return axis.join(df, [*keys, ts], "left").select(*df.columns)


def fill_gaps(
    df: DataFrame,
    ts: str,
    step: str,
    keys: Sequence[str] = (),
    *,
    ties: Sequence[str] = (),
    width: int | None = None,
    max_rows: int = MAX_BLOCK_ROWS,
) -> DataFrame:
    """The rows, and a row of nulls for every step that is missing between a row and the next of its key.

    Every key has a span of its own, from its first to its last row: a key with one row stays one row. Rows stay
    as they are, also those that lie off the steps; steps are counted from each row on. `step` is an interval
    of fixed length. Rows are never joined with an axis: each makes the points up to its successor,
    which lies in its own block or is the first of the next.
    """
    kind = df.schema[ts].dataType.simpleString()
    blocked = with_block(df, ts, keys, ties, width, max_rows)
    by = [quoted(c) for c in [*keys, BLOCK]]
    at = quoted(ts)
    first = blocked.groupBy(*keys, BLOCK).agg(F.min(ts).alias("__first")).selectExpr(
        *by, f"first(__first) {over_summaries(keys, reverse=True, frame='rows between 1 preceding and 1 preceding')} as __after"
    )
    following = over_block(ts, keys, ties, frame="rows between 1 following and 1 following")
    rows = blocked.selectExpr("*", f"first({at}) {following} as __next").join(first, [*keys, BLOCK])
    here, until = f"timestamp({at})", "timestamp(coalesce(__next, __after))"
    points = (
        f"case when {until} > {here} + interval {step} then "
        f"filter(sequence({here} + interval {step}, {until}, interval {step}), t -> t < {until}) end"
    )
    # Element 0 is the row itself, the others are the missing points after it.
    all_points = f"concat(array(timestamp({at})), coalesce({points}, array()))"
    exploded = rows.selectExpr(*map(quoted, df.columns), f"posexplode({all_points}) as (__k, __at)")
    cells = [
        quoted(c) if c in keys
        else f"cast(__at as {kind}) as {at}" if c == ts
        else f"case when __k = 0 then {quoted(c)} end as {quoted(c)}"
        for c in df.columns
    ]
    return exploded.selectExpr(*cells)
