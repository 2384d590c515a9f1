"""Rolling figures over the last n rows of a series."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from squall.operators.blocks import (
    BLOCK,
    MAX_BLOCK_ROWS,
    over_block,
    over_summaries,
    with_block,
)
from squall.operators.columns import quoted
from squall.storage import materialise

HALO = "__halo"


def rolling(
    df: DataFrame,
    figures: dict[str, tuple[str, str]],
    *,
    rows: int = 24,
    ts: str,
    keys: Sequence[str] = (),
    ties: Sequence[str] = (),
    width: int | None = None,
    max_rows: int = MAX_BLOCK_ROWS,
) -> DataFrame:
    """Add `{name: (column, aggregate)}` over the last `rows` rows, null unless all are present.

    The aggregate is the name of a SQL function such as `avg`. Every block first receives the last
    `rows - 1` rows before it as halo, so the frames at its start are whole; the halo is dropped
    afterwards. Blocks of fewer rows than that are put together first, so a row is copied twice at most.
    """
    used = sorted({col for col, _ in figures.values()})
    blocked = with_block(df, ts, keys, ties, width, max_rows)
    if rows > 1:
        blocked, counts = _wide_blocks(blocked, rows - 1, keys)
        halo = _halo(blocked, counts, used, rows - 1, ts, keys, ties)
        both = blocked.withColumn(HALO, F.lit(False)).unionByName(
            halo.withColumn(HALO, F.lit(True)), allowMissingColumns=True
        )
    else:
        both = blocked.withColumn(HALO, F.lit(False))
    frame = over_block(
        ts, keys, ties, frame=f"rows between {rows - 1} preceding and current row"
    )
    added = [
        f"case when count({quoted(col)}) {frame} = {rows} then {fn}({quoted(col)}) {frame} end "
        f"as {quoted(name)}"
        for name, (col, fn) in figures.items()
    ]
    kept = [quoted(c) for c in df.columns if c not in figures]
    return both.selectExpr(*kept, HALO, *added).filter(f"not {HALO}").drop(HALO)


def rolling_mean(df: DataFrame, col: str, name: str, **axis) -> DataFrame:
    return rolling(df, {name: (col, "avg")}, **axis)


def rolling_sum(df: DataFrame, col: str, name: str, **axis) -> DataFrame:
    return rolling(df, {name: (col, "sum")}, **axis)


def _counts(blocked: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of each block, and of all blocks of its key before it."""
    by = [quoted(c) for c in [*keys, BLOCK]]
    counts = blocked.groupBy(*keys, BLOCK).agg(F.count(F.lit(1)).alias("__n"))
    before = f"coalesce(sum(__n) {over_summaries(keys)}, 0)"
    return counts.selectExpr(*by, "__n", f"{before} as __before")


def _wide_blocks(blocked: DataFrame, n: int, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """The rows with blocks of which any two neighbours hold `n` rows, and the counts of these blocks.

    Blocks that begin within the same `n` rows of their key become one; where every block but a key's
    last has `n` rows already, nothing changes and no join is needed.
    """
    counts = materialise(_counts(blocked, keys), "block-counts")
    end = f"max(__before) over (partition by {', '.join(map(quoted, keys)) or '1'})"
    if counts.selectExpr("__n", f"__before < {end} as __followed").filter(f"__followed and __n < {n}").isEmpty():
        return blocked, counts
    group = f"cast(floor(__before / {n}) as bigint)"
    groups = counts.selectExpr(*[quoted(c) for c in [*keys, BLOCK]], f"{group} as __group")
    merged = counts.groupBy(*keys, F.expr(group).alias(BLOCK)).agg(
        F.sum("__n").alias("__n"), F.min("__before").alias("__before")
    )
    rows = blocked.join(groups, [*keys, BLOCK]).drop(BLOCK).withColumnRenamed("__group", BLOCK)
    return rows, merged


def _halo(blocked: DataFrame, counts: DataFrame, cols, n: int, ts: str, keys, ties) -> DataFrame:
    """The `n` rows before each block, copied into it.

    The last rows of a block go to the next one, and to the one after that if the next is short of `n`. The
    rank filter is applied before the shuffle (window group limit), so only block ends move.
    """
    fields = list(dict.fromkeys([*keys, ts, *ties, *cols]))
    by = [quoted(c) for c in [*keys, BLOCK]]
    series = f"over (partition by {', '.join(map(quoted, keys)) or '1'} order by {BLOCK})"
    near = f"named_struct('to', lead({BLOCK}) {series}, 'gap', 0L)"
    far = f"named_struct('to', lead({BLOCK}, 2) {series}, 'gap', lead(__n) {series})"
    receivers = counts.selectExpr(*by, f"array({near}, {far}) as __receivers").selectExpr(
        *by, f"filter(__receivers, r -> r.to is not null and r.gap < {n}) as __receivers"
    )
    last = over_block(ts, keys, ties, reverse=True)
    ends = (
        blocked.select(*[c for c in fields if c != BLOCK], BLOCK)
        .selectExpr("*", f"row_number() {last} as __rank")
        .filter(f"__rank <= {n}")
    )
    sent = ends.join(receivers, [*keys, BLOCK]).drop(BLOCK)
    copies = sent.selectExpr(*map(quoted, fields), "__rank", "inline(__receivers) as (__to, __gap)")
    return copies.filter(f"__rank <= {n} - __gap").selectExpr(
        *map(quoted, fields), f"__to as {BLOCK}"
    )
