"""Registration of queries and their SQL."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from squall.operators.columns import quoted
from squall.session import configure

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

DIGITS = 1_000_000
# Means of decimal numbers often lie exactly half-way between two printed values, where the order of
# summation would decide. This moves the half-way point off that lattice, alike in both engines.
OFF_LATTICE = 0.01


def case(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; without `sql` it is only checked for its rows."""

    def register(query: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} exists already")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return presented(query(configure(spark), sf_dir))

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return query

    return register


def presented(df: DataFrame) -> DataFrame:
    """Result as both engines print it: doubles to 6 digits, dates and times as text."""

    def show(f: T.StructField) -> str:
        c = quoted(f.name)
        if isinstance(f.dataType, T.DoubleType):
            return f"rint({c} * {DIGITS} + {OFF_LATTICE}D) / {DIGITS} + 0D as {c}"
        if isinstance(f.dataType, T.DateType):
            return f"date_format({c}, 'yyyy-MM-dd') as {c}"
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            return f"date_format({c}, 'yyyy-MM-dd HH:mm:ss.SSSSSS') as {c}"
        return c

    return df.selectExpr(*[show(f) for f in df.schema])


def num(expression: str, alias: str | None = None) -> str:
    """SQL of a double as `presented` shows it."""
    value = f"cast({expression} as double) * {DIGITS} + {OFF_LATTICE}e0"
    return f"round_even({value}, 0) / {DIGITS} + 0.0 as {alias or expression}"


def nums(*columns: str) -> str:
    return ", ".join(num(c) for c in columns)


def day(expression: str, alias: str) -> str:
    return f"strftime(cast({expression} as timestamp), '%Y-%m-%d') as {alias}"


def stamp(expression: str, alias: str) -> str:
    return f"strftime(cast({expression} as timestamp), '%Y-%m-%d %H:%M:%S.%f') as {alias}"
