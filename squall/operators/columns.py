"""Column choice by type, role or content."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROLE = "role"
CATEGORY = "category"


def parse_time(col: Column, fmt: str | None = None, tolerant: bool = False) -> Column:
    """String, date or timestamp to timestamp; `tolerant` turns bad text into null."""
    if tolerant:
        return F.try_to_timestamp(col, None if fmt is None else F.lit(fmt))
    return F.to_timestamp(col, fmt)


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN means "missing" in floating columns; everything downstream expects null."""
    floats = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return replaced(df, df, {c: f"nullif({quoted(c)}, double('NaN'))" for c in floats})


def quoted(name: str) -> str:
    """Column name in SQL text. Wide operators build text: it plans much faster than Columns."""
    return "`" + name.replace("`", "``") + "`"


def replaced(df: DataFrame, source: DataFrame, new: dict[str, str]) -> DataFrame:
    """Columns of `df` in their order taken from `source`, some replaced by SQL expressions.

    Column metadata (roles) is kept.
    """
    marked = [f.name for f in df.schema if f.name in new and f.metadata.get(ROLE) == CATEGORY]
    rows = source.selectExpr(
        *[f"{new[c]} as {quoted(c)}" if c in new else quoted(c) for c in df.columns]
    )
    return as_category(rows, marked) if marked else rows


def drop_columns(df: DataFrame, cols: Sequence[str], strict: bool = True) -> DataFrame:
    missing = [c for c in cols if c not in df.columns]
    if strict and missing:
        raise ValueError(f"no such columns: {missing}")
    return df.drop(*cols)


def non_null_counts(df: DataFrame, cols: Sequence[str]) -> dict[str, int]:
    """Non-null values per column: one aggregate, one row to the driver."""
    if not cols:
        return {}
    return df.agg(*[F.count(c).alias(c) for c in cols]).first().asDict()


def drop_all_null_columns(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    counts = non_null_counts(df, df.columns if cols is None else cols)
    return df.drop(*[c for c, n in counts.items() if n == 0])


def as_category(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Mark columns as categories; the values stay as they are."""
    marked = {c: F.col(c).alias(c, metadata={ROLE: CATEGORY}) for c in cols}
    return df.select(*[marked.get(c, F.col(c)) for c in df.columns])


def is_category(df: DataFrame, col: str) -> bool:
    return df.schema[col].metadata.get(ROLE) == CATEGORY


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """Numeric columns that are not marked as categories."""
    return [
        f.name
        for f in df.schema
        if isinstance(f.dataType, T.NumericType)
        and f.name not in exclude
        and f.metadata.get(ROLE) != CATEGORY
    ]


def select_numeric(df: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    return df.select(*numeric_columns(df, exclude))


def select_features(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """Model input of one target."""
    return df.select(*features, target)


def mark_selected(df: DataFrame, date: str, day: str) -> DataFrame:
    return df.withColumn("Selected", F.col(date).cast("date") == F.lit(day).cast("date"))


def within_horizon(df: DataFrame, date: str, as_of: str, days: int = 7) -> DataFrame:
    """Rows dated from `as_of` to `as_of + days`, both included."""
    start = F.lit(as_of).cast("date")
    return df.filter(F.col(date).between(start, F.date_add(start, days)))
