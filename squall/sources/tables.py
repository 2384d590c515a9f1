"""CSV and Parquet tables."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from squall.operators.columns import nan_to_null

STAMP = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header and a declared schema; a file with other columns fails the read."""
    frame = (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .option("nanValue", "NaN")
        .option("timestampFormat", STAMP)
        .csv(path)
    )
    return nan_to_null(frame)


def write_csv(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    writer = df.write.mode("overwrite").option("header", True).option("timestampFormat", STAMP)
    (writer.partitionBy(*partition_by) if partition_by else writer).csv(path)


def write_observations(df: DataFrame, path: str, ts: str) -> None:
    """Parquet by year and month of the time axis, so a date range reads only its folders.

    Rows of a month are brought together for few, large files. The rebalance hint lets adaptive
    execution split a month that holds much of the data over many tasks.
    """
    parted = df.withColumns({"year": F.year(ts), "month": F.month(ts)})
    rebalanced = parted.hint("rebalance", "year", "month")
    rebalanced.write.mode("overwrite").partitionBy("year", "month").parquet(path)


def read_observations(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def select_variables(df: DataFrame, axis: Sequence[str], variables: Sequence[str]) -> DataFrame:
    """Projection to the requested variables; one that the table lacks becomes a null column."""

    def variable(name: str) -> Column:
        return F.col(name) if name in df.columns else F.lit(None).cast("double").alias(name)

    return df.select(*axis, *[variable(v) for v in variables])


def source_filter(
    df: DataFrame,
    ts: str,
    start: str | None = None,
    end: str | None = None,
    stations: Sequence[str] | DataFrame | None = None,
    station: str = "station",
    by_month: bool = False,
) -> DataFrame:
    """Rows of some stations between two times, both included.

    The bounds have the column's own type, so they reach the Parquet reader. `by_month` says that the
    table was written by `write_observations`, so whole year and month folders can be left out too.
    """
    kind = df.schema[ts].dataType

    def months(at: Column) -> Column:
        return F.year(at) * 12 + F.month(at)

    folder = F.col("year") * 12 + F.col("month") if by_month else None
    if start is not None:
        low = F.lit(start).cast(kind)
        df = df.filter(F.col(ts) >= low)
        df = df.filter(folder >= months(low)) if by_month else df
    if end is not None:
        high = F.lit(end).cast(kind)
        df = df.filter(F.col(ts) <= high)
        df = df.filter(folder <= months(high)) if by_month else df
    if isinstance(stations, DataFrame):
        return df.join(stations.select(station), station, "left_semi")
    return df if stations is None else df.filter(F.col(station).isin(list(stations)))


def write_sensitivity(table: DataFrame, path: str) -> None:
    """One CSV folder per target."""
    write_csv(table, path, ["target"])
