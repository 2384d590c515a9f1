"""Column statistics per station and their way back to the rows.

A statistics table has one row per key with one struct column, `STATS`, that maps each data column
to a struct of its figures. All columns are aggregated in one pass.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from squall.operators.columns import quoted
from squall.storage import materialise

STATS = "__stats"


def column_stats(
    df: DataFrame, cols: Sequence[str], figures: dict[str, str], keys: Sequence[str] = ()
) -> DataFrame:
    """`figures` maps a name to the SQL of an aggregate of `{x}`, e.g. `{"mean": "avg({x})"}`."""
    cells = {c: struct({n: f.format(x=quoted(c)) for n, f in figures.items()}) for c in cols}
    return gathered(df, cells, keys)


def gathered(df: DataFrame, cells: dict[str, str], keys: Sequence[str] = ()) -> DataFrame:
    """Aggregate to one `STATS` struct per key; `cells` maps column name to aggregate SQL."""
    return df.groupBy(*keys).agg(F.expr(struct(cells)).alias(STATS))


def struct(fields: dict[str, str]) -> str:
    """SQL of a struct from field name to SQL."""
    inner = ", ".join(f"'{name}', {sql}" for name, sql in fields.items())
    return f"named_struct({inner})"


def attach(
    df: DataFrame, stats: DataFrame, keys: Sequence[str] = (), written: bool = False
) -> DataFrame:
    """Add the `STATS` struct to every row.

    Without keys there is exactly one statistics row: a scalar subquery, no join. With keys the
    table is written first (unless it already is), so the planner broadcasts it only if its files
    are small enough and otherwise runs a sort-merge join with skew handling. Keys are non-null.
    """
    if not keys:
        return df.withColumn(STATS, stats.select(STATS).scalar())
    if not written:
        stats = materialise(stats, "stats")
    return df.join(stats, list(keys), "left")


def figure(col: str, name: str) -> str:
    """SQL of one figure of one column, for rows that carry `STATS`."""
    return f"{STATS}.{quoted(col)}.{name}"


def unstacked(cells: Sequence[str]) -> str:
    """SQL that turns structs into rows."""
    return f"inline(array({', '.join(cells)}))"


def to_long(
    stats: DataFrame, cols: Sequence[str], names: Sequence[str], keys: Sequence[str] = ()
) -> DataFrame:
    """One row per key and column: `(keys…, column, names…)`."""
    cells = [
        struct({"column": f"'{c}'"} | {n: f"double({figure(c, n)})" for n in names}) for c in cols
    ]
    return stats.selectExpr(*map(quoted, keys), unstacked(cells))


def to_wide(
    table: DataFrame, cols: Sequence[str], names: Sequence[str], keys: Sequence[str] = ()
) -> DataFrame:
    """Inverse of `to_long`, for statistics read back from storage."""
    fields = struct({n: quoted(n) for n in names})
    cells = {c: f"first(case when column = '{c}' then {fields} end, true)" for c in cols}
    return gathered(table, cells, keys)


def global_min_max(df: DataFrame, cols: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    stats = column_stats(df, cols, {"min": "min({x})", "max": "max({x})"}, keys)
    return to_long(stats, cols, ["min", "max"], keys)
