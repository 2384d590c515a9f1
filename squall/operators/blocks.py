"""Cutting long series into blocks of bounded size.

A window over a whole series puts all rows of a station in one task, and one station may hold a
third of the data. Order-dependent operators therefore work per `(keys, BLOCK)`: inside a block with
an ordinary window, across blocks through one summary row (or a few halo rows) per block.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from squall.operators.columns import quoted
from squall.storage import materialise

BLOCK = "__block"
MAX_BLOCK_ROWS = 1_000_000
HOUR = 3_600
DAY = 24 * HOUR
WIDTHS = (360 * DAY, 30 * DAY, DAY, HOUR)


def epoch_seconds(df: DataFrame, ts: str) -> Column:
    """Seconds since 1970 of a date or timestamp column, increasing with it."""
    kind = df.schema[ts].dataType
    col = F.col(ts)
    if isinstance(kind, T.TimestampType):
        return F.unix_seconds(col)
    days = F.unix_date(col.cast("date")).cast("long") * DAY
    if isinstance(kind, T.DateType):
        return days
    return days + F.hour(col) * HOUR + F.minute(col) * 60 + F.second(col)


def time_block(df: DataFrame, ts: str, width: int) -> Column:
    return F.floor(epoch_seconds(df, ts) / width)


def with_block(
    df: DataFrame,
    ts: str,
    keys: Sequence[str] = (),
    ties: Sequence[str] = (),
    width: int | None = None,
    max_rows: int = MAX_BLOCK_ROWS,
) -> DataFrame:
    """Add `BLOCK`, a number that rises with `(ts, ties)` inside each key.

    Pass `width` (seconds) when the grain of the axis bounds the rows in a block, e.g. 90 days of an
    hourly axis. Without it the widest calendar block whose fullest instance holds at most
    `max_rows` rows is measured; if even an hour holds more, rows are range-partitioned instead.
    """
    if width is None:
        width = fitting_width(df, ts, keys, max_rows)
    if width is None:
        return range_blocks(df, [*keys, ts, *ties], max_rows)
    return df.withColumn(BLOCK, time_block(df, ts, width))


def fitting_width(
    df: DataFrame, ts: str, keys: Sequence[str] = (), max_rows: int = MAX_BLOCK_ROWS
) -> int | None:
    """Widest of `WIDTHS` whose fullest block of any key holds at most `max_rows` rows.

    Counts are combined map-side and only the largest reaches the driver. A width that cannot fit,
    given the count at a wider one, is not tried.
    """
    at_least = 0.0
    wider = WIDTHS[0]
    for width in WIDTHS:
        if at_least * width / wider > max_rows:
            continue
        counts = df.groupBy(*keys, time_block(df, ts, width).alias(BLOCK)).count()
        fullest = counts.agg(F.max("count")).first()[0] or 0
        if fullest <= max_rows:
            return width
        at_least, wider = fullest, width
    return None


def range_blocks(df: DataFrame, order: Sequence[str], max_rows: int = MAX_BLOCK_ROWS) -> DataFrame:
    """Even blocks whatever the skew in keys or time, as a written table.

    Written, because the block number is the partition a row was in: it has to be a stored fact
    before anything else may rely on it.
    """
    parts = df.count() // max_rows + 1
    ranged = df.repartitionByRange(parts, *order).withColumn(
        BLOCK, F.spark_partition_id().cast("long")
    )
    return materialise(ranged, "blocks")


def position(ts: str, ties: Sequence[str] = ()) -> str:
    """SQL of the sort position of a row as one value."""
    names = ", ".join(map(quoted, [ts, *ties]))
    return f"struct({names})" if ties else names


def over_block(
    ts: str,
    keys: Sequence[str] = (),
    ties: Sequence[str] = (),
    reverse: bool = False,
    frame: str = "rows between unbounded preceding and current row",
) -> str:
    """SQL window over one block in time order (or against it)."""
    by = ", ".join(map(quoted, [*keys, BLOCK]))
    order = ", ".join(f"{quoted(c)} {'desc' if reverse else 'asc'}" for c in [ts, *ties])
    return f"over (partition by {by} order by {order} {frame})"


def over_summaries(
    keys: Sequence[str] = (),
    reverse: bool = False,
    frame: str = "rows between unbounded preceding and 1 preceding",
) -> str:
    """SQL window over the block summaries of one key; only ever used on those."""
    by = f"partition by {', '.join(map(quoted, keys))} " if keys else ""
    return f"over ({by}order by {BLOCK} {'desc' if reverse else 'asc'} {frame})"


def row_index(
    df: DataFrame,
    name: str,
    *,
    ts: str,
    keys: Sequence[str] = (),
    ties: Sequence[str] = (),
    width: int | None = None,
    max_rows: int = MAX_BLOCK_ROWS,
) -> DataFrame:
    """Consecutive row number from 1 per key in `(ts, ties)` order."""
    blocked = with_block(df, ts, keys, ties, width, max_rows)
    offsets = (
        blocked.groupBy(*keys, BLOCK)
        .count()
        .selectExpr(
            *map(quoted, [*keys, BLOCK]),
            f"coalesce(sum(count) {over_summaries(keys)}, 0) as __offset",
        )
    )
    numbered = blocked.selectExpr("*", f"row_number() {over_block(ts, keys, ties)} as __n")
    return numbered.join(offsets, [*keys, BLOCK]).selectExpr(
        *[quoted(c) for c in df.columns if c != name], f"__n + __offset as {quoted(name)}"
    )
