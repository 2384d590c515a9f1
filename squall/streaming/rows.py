"""New observation files as a stream.

Only row-wise features run here; fills, rolling figures and scaling look at the whole series and
stay batch.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from squall.functions.binning import season, wind_category
from squall.functions.calendar import calendar_features
from squall.functions.comfort import dew_point_depression, heat_index, wind_chill
from squall.functions.rates import hourly_flags


def read_stream(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    return spark.readStream.schema(schema).parquet(folder)


def row_features(df: DataFrame, ts: str = "datetime") -> DataFrame:
    """The stateless hourly features; batch and stream alike."""
    t, rain, wind = F.col("temperature_2m"), F.col("precipitation"), F.col("wind_speed_10m")
    return df.withColumns(
        calendar_features(F.col(ts), hourly=True)
        | hourly_flags(t, rain, F.col("snowfall"))
        | {
            "season": season(F.col(ts)),
            "wind_chill": wind_chill(t, wind),
            "heat_index": heat_index(t, F.col("relative_humidity_2m")),
            "dew_point_depression": dew_point_depression(t, F.col("dew_point_2m")),
            "wind_category": wind_category(wind),
        }
    )


def write_available(stream: DataFrame, folder: str, checkpoint: str) -> None:
    """Process every file that is there, append the result to `folder`, and stop."""
    query = (
        stream.writeStream.format("parquet")
        .option("path", folder)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
