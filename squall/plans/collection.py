"""The whole way of one dataset: ingest, features, plot data, profile, checks."""

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from squall.operators.checks import (
    Checks,
    check_schema_artifact,
    checks_table,
    suite,
    validate_suite,
    write_checked,
)
from squall.operators.columns import numeric_columns
from squall.operators.eda import boxplot, correlation_matrix, histogram, kde, profile
from squall.operators.profiles import compare_profiles, partial_profile
from squall.plans.daily import daily_features
from squall.plans.hourly import hourly_features
from squall.sources.responses import ingest_daily, ingest_hourly
from squall.storage import materialise

# Charted columns of each grain.
DAILY_CHARTS = {"temperature": "temperature_2m_max", "precipitation": "precipitation_sum"}
HOURLY_CHARTS = {"temperature": "temperature_2m", "precipitation": "precipitation"}


@dataclass
class Collected:
    """Stored engineered rows and scaler, and the tables derived from them when asked for."""

    dataset: str
    rows: DataFrame
    scaler: DataFrame
    keys: Sequence[str]
    charts: dict[str, str]
    tolerated: Sequence[str]

    @property
    def numbers(self) -> list[str]:
        return numeric_columns(self.rows, exclude=self.keys)

    @property
    def schema(self) -> str:
        return self.rows.schema.json()

    @cached_property
    def correlation(self) -> DataFrame:
        return correlation_matrix(self.rows, self.numbers)

    @cached_property
    def temperature_histogram(self) -> DataFrame:
        return histogram(self.rows, self.charts["temperature"])

    @cached_property
    def temperature_density(self) -> DataFrame:
        return kde(self.rows, self.charts["temperature"])

    @cached_property
    def precipitation_by_season(self) -> DataFrame:
        return boxplot(self.rows, "season", self.charts["precipitation"])

    @cached_property
    def profile(self) -> DataFrame:
        return profile(self.rows, self.numbers)

    @cached_property
    def validation(self) -> DataFrame:
        return validate_suite(self.rows, self.dataset, self.tolerated)

    def schema_check(self, stored: str) -> DataFrame:
        """The rows against the schema an earlier run stored."""
        return check_schema_artifact(self.rows, stored)


def collect_daily(
    raw: DataFrame, keys: Sequence[str] = (), tolerated: Sequence[str] = (), **options
) -> Collected:
    rows, scaler = daily_features(raw, keys, **options)
    rows = materialise(rows, "daily-engineered")
    return Collected("daily", rows, scaler, keys, DAILY_CHARTS, tolerated)


def collect_hourly(
    raw: DataFrame, keys: Sequence[str] = (), tolerated: Sequence[str] = (), **options
) -> Collected:
    rows, scaler = hourly_features(raw, keys, **options)
    rows = materialise(rows, "hourly-engineered")
    return Collected("hourly", rows, scaler, keys, HOURLY_CHARTS, tolerated)


_MANIFEST = "artifact string, rows bigint, passed boolean"


@dataclass
class CollectionRun:
    """A folder with one table per artifact and, written last, the manifest of them.

    A folder without manifest is that of a run that did not end.
    """

    spark: SparkSession
    folder: str
    done: list[tuple[str, int, bool]] = field(default_factory=list)

    def store(
        self, name: str, table: DataFrame, checks: Checks | None = None, passed: bool | None = None
    ) -> dict[str, int]:
        """Write a table and count its rows and violations on the way; it passes without violations.

        `passed` overrules that for tables that say themselves whether something passed.
        """
        counted = write_checked(table, f"{self.folder}/{name}", checks)
        fine = not any(n for check, n in counted.items() if check != "rows")
        self.done.append((name, counted["rows"], fine if passed is None else passed))
        return counted

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}")

    def end(self) -> None:
        manifest = self.spark.createDataFrame(self.done, _MANIFEST)
        manifest.coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/manifest")

    @property
    def manifest(self) -> DataFrame:
        return self.table("manifest")


def run_daily(
    responses: DataFrame, folder: str, previous: str | None = None, tolerated: Sequence[str] = (), **options
) -> CollectionRun:
    """Answers of a source to everything the daily dataset is asked for; see `_run`."""
    return _run(
        "daily", ingest_daily, daily_features, DAILY_CHARTS, responses, folder, previous, tolerated, options
    )


def run_hourly(
    responses: DataFrame, folder: str, previous: str | None = None, tolerated: Sequence[str] = (), **options
) -> CollectionRun:
    """Answers of a source to everything the hourly dataset is asked for; see `_run`."""
    return _run(
        "hourly", ingest_hourly, hourly_features, HOURLY_CHARTS, responses, folder, previous, tolerated, options
    )


def _run(
    dataset: str,
    ingest: Callable[[DataFrame], DataFrame],
    features: Callable[..., tuple[DataFrame, DataFrame]],
    charts: dict[str, str],
    responses: DataFrame,
    folder: str,
    previous: str | None,
    tolerated: Sequence[str],
    options: dict,
) -> CollectionRun:
    """Ingest, features, plot data, profile, schema, validation and schema check, each stored under `folder`.

    Every table is written once and read by the steps after it. The engineered rows are checked while they
    are written. Their schema and their profile are compared with those of the run under `previous`;
    the first run is compared with its own stored schema. `options` go to the feature plan.
    """
    run, keys = CollectionRun(responses.sparkSession, folder), ["station"]
    run.store("raw", ingest(responses))
    rows, scaler = features(run.table("raw"), keys, **options)
    counted = run.store("engineered", rows, suite(rows, tolerated))
    run.store("scaler", scaler)
    # The written rows with the roles of their columns, which the files do not hold.
    written = run.spark.read.schema(rows.schema).parquet(f"{folder}/engineered")
    collected = Collected(dataset, written, run.table("scaler"), keys, charts, tolerated)
    run.store("correlation", collected.correlation)
    run.store("temperature_histogram", collected.temperature_histogram)
    run.store("temperature_density", collected.temperature_density)
    run.store("precipitation_by_season", collected.precipitation_by_season)
    run.store("profile", partial_profile(written, collected.numbers))
    run.store("schema", run.spark.createDataFrame([(rows.schema.json(),)], "schema string"))
    checks = checks_table(run.spark, dataset, counted)
    run.store("validation", checks, passed=not any(n for c, n in counted.items() if c != "rows"))
    stored = run.spark.read.parquet(f"{previous or folder}/schema").first().schema
    compared = collected.schema_check(stored)
    same = compared.filter("status <> 'same'").isEmpty()
    run.store("schema_check", compared, passed=same)
    if previous is not None:
        before = run.spark.read.parquet(f"{previous}/profile")
        drift = compare_profiles(before, run.table("profile"))
        run.store("profile_check", drift, passed=drift.filter("status <> 'same'").isEmpty())
    run.end()
    return run
