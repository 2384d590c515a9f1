"""Integer codes of categories."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from squall.operators.blocks import MAX_BLOCK_ROWS, row_index
from squall.storage import materialise


def factorize_codes(
    df: DataFrame, col: str, *, ts: str, keys: Sequence[str] = (), max_rows: int = MAX_BLOCK_ROWS
) -> DataFrame:
    """`(keys…, col, code)`: codes from 0 in order of first appearance, ties by value.

    A key with more than `max_rows` categories is numbered block by block.
    """
    first_seen = (
        df.filter(F.col(col).isNotNull()).groupBy(*keys, col).agg(F.min(ts).alias("__first"))
    )
    first_seen = materialise(first_seen, "categories")
    most = first_seen.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0
    if most <= max_rows:
        order = Window.partitionBy(*keys).orderBy("__first", col)
        coded = first_seen.withColumn("code", F.row_number().over(order))
    else:
        coded = row_index(first_seen, "code", ts="__first", keys=keys, ties=[col], max_rows=max_rows)
    return coded.select(*keys, col, (F.col("code") - 1).cast("int").alias("code"))


def factorize(
    df: DataFrame,
    col: str,
    *,
    ts: str,
    keys: Sequence[str] = (),
    name: str | None = None,
    max_rows: int = MAX_BLOCK_ROWS,
) -> DataFrame:
    """Replace `col` by its code (or add it as `name`); null becomes -1.

    The codes derive from a written table, so the planner knows whether they are small enough to
    broadcast.
    """
    name = name or col
    codes = factorize_codes(df, col, ts=ts, keys=keys, max_rows=max_rows).withColumnRenamed("code", "__code")
    joined = df.join(codes, [*keys, col], "left")
    code = F.coalesce("__code", F.lit(-1)).alias(name)
    columns = [code if c == name else F.col(c) for c in df.columns]
    return joined.select(*columns, *([] if name in df.columns else [code]))
