"""Feature and target names, the training extract and its split."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from squall.functions.calendar import calendar_features
from squall.storage import materialise

# Targets and model inputs of the two grains.
DAILY_TARGETS = ("apparent_temperature_max",)
HOURLY_TARGETS = ("apparent_temperature", "precipitation", "rain")
DAILY_FEATURES = ("month", "day_of_year", "week_of_year", "is_weekend")
HOURLY_FEATURES = ("hour", "month", "day_of_year", "week_of_year", "is_weekend")


def training_extract(df: DataFrame, ts: str, hourly: bool) -> DataFrame:
    """Observations with their calendar features, written once for all later model steps."""
    return materialise(df.withColumns(calendar_features(F.col(ts), hourly)), "training")


def in_test_part(cols: Sequence[str], seed: int = 42, test_percent: int = 20) -> Column:
    """Whether a row belongs to the test part, decided by a hash of its identity.

    The same row lands in the same part whatever the partitioning, the run or the engine: md5 of
    the identity and the seed, first 8 hex digits, modulo 100.
    """
    identity = F.concat_ws("|", *[F.col(c).cast("string") for c in cols], F.lit(str(seed)))
    bucket = F.conv(F.substring(F.md5(identity), 1, 8), 16, 10).cast("long") % 100
    return bucket < test_percent


def train_test_split(
    df: DataFrame, identity: Sequence[str], seed: int = 42, test_percent: int = 20
) -> tuple[DataFrame, DataFrame]:
    test = in_test_part(identity, seed, test_percent)
    return df.filter(~test), df.filter(test)


def combinations(
    df: DataFrame, features: Sequence[str], targets: Sequence[str] = ()
) -> DataFrame:
    """Distinct feature rows with their row count and, per target, mean and number of values.

    Calendar features take few values (at most 366 days x 14 week/weekend layouts x 24 hours), so
    this is small however many rows there are. It is all a model needs: under squared error a row
    set and its mean with the count as weight give the same splits and leaves.
    """
    sums = {f"{t}__mean": F.avg(t) for t in targets} | {f"{t}__n": F.count(t) for t in targets}
    aggregates = [F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in sums.items()]]
    return materialise(df.groupBy(*features).agg(*aggregates), "combinations")
