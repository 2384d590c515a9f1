"""Predictors: feature columns in, one `<target>_prediction` column per target out."""

import re
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from squall.models.features import combinations
from squall.storage import materialise

# Size of a model.
TREES = 100
DEPTH = 5
RATE = 0.1
SEED = 42
MAX_BINS = 400  # above the 366 days of a year, so every calendar value can be a split
TASK_COMBINATIONS = 50_000  # trained on in one task


def prediction(target: str) -> str:
    return f"{target}_prediction"


class Predictor:
    features: Sequence[str]
    targets: Sequence[str]

    def score(self, rows: DataFrame) -> DataFrame:
        """Add the predictions to a table of feature rows."""
        raise NotImplementedError

    def save(self, folder: str) -> None:
        raise NotImplementedError


@dataclass
class TreeModels(Predictor):
    """One gradient-boosted regressor per target."""

    models: dict[str, PipelineModel]
    features: Sequence[str]

    @property
    def targets(self) -> Sequence[str]:
        return tuple(self.models)

    def score(self, rows: DataFrame) -> DataFrame:
        for target, model in self.models.items():
            rows = model.transform(rows).drop("features")
            rows = rows.withColumnRenamed("prediction", prediction(target))
        return rows

    def save(self, folder: str) -> None:
        """One directory per target."""
        for target, model in self.models.items():
            model.write().overwrite().save(f"{folder}/{target}")


def train_models(
    df: DataFrame,
    features: Sequence[str],
    targets: Sequence[str],
    *,
    trees: int = TREES,
    depth: int = DEPTH,
    rate: float = RATE,
    seed: int = SEED,
    parallelism: int = 4,
) -> TreeModels:
    """Fit one regressor per target on the distinct feature rows, weighted by their counts.

    The training set is small, so a fit is a long chain of short jobs; up to `parallelism` targets
    submit theirs at the same time. A chain over a few combinations runs in as few tasks.
    """
    combos = combinations(df, features, targets)
    combos = combos.coalesce(1 + combos.count() // TASK_COMBINATIONS)
    bins = max(MAX_BINS, _most_values(combos, features) + 1)

    @inheritable_thread_target(df.sparkSession)
    def fit(target: str) -> PipelineModel:
        return _fit(combos, features, target, trees, depth, rate, seed, bins)

    with ThreadPoolExecutor(min(parallelism, len(targets))) as pool:
        return TreeModels(dict(zip(targets, pool.map(fit, targets))), tuple(features))


def _most_values(combos: DataFrame, features: Sequence[str]) -> int:
    """Distinct values of the feature that has most: as many splits a tree must be able to tell apart."""
    counts = combos.agg(*[F.count_distinct(f).alias(f) for f in features]).first()
    return max(counts, default=0)


def _fit(combos, features, target, trees, depth, rate, seed, bins=MAX_BINS) -> PipelineModel:
    regressor = GBTRegressor(
        labelCol=f"{target}__mean",
        weightCol=f"{target}__n",
        maxIter=trees,
        maxDepth=depth,
        stepSize=rate,
        seed=seed,
        maxBins=bins,
    )
    known = combos.filter(F.col(f"{target}__n") > 0)
    assembler = VectorAssembler(inputCols=list(features), outputCol="features")
    return Pipeline(stages=[assembler, regressor]).fit(known)


def first_split(models: TreeModels) -> list[tuple[str, str, float, float, float]]:
    """`(target, feature, threshold, left, right)` of the first tree of each model that has depth one."""
    found = []
    for target, model in models.models.items():
        text = model.stages[-1].trees[0].toDebugString
        cut = re.search(r"If \(feature (\d+) <= ([-+.\dE]+)\)\s+Predict: ([-+.\dE]+)\s+Else .*\s+Predict: ([-+.\dE]+)", text)
        if cut:
            found.append((target, models.features[int(cut[1])], *map(float, cut.groups()[1:])))
    return found


def load_models(folder: str, targets: Sequence[str], features: Sequence[str]) -> TreeModels:
    return TreeModels({t: PipelineModel.load(f"{folder}/{t}") for t in targets}, tuple(features))


@dataclass
class Climatology(Predictor):
    """Mean of each target by (month, is_weekend).

    Our own addition: a closed form that SQL can repeat, used to check the analysis operators and
    as the baseline that a trained model has to beat. Combinations never seen get the overall mean.
    """

    table: DataFrame
    targets: Sequence[str]
    features: Sequence[str] = ("month", "is_weekend")

    def score(self, rows: DataFrame) -> DataFrame:
        overall = self.table.agg(
            F.struct(
                *[
                    F.try_divide(F.sum(f"{t}__sum"), F.sum(f"{t}__n")).alias(t)
                    for t in self.targets
                ]
            )
        ).scalar()
        known = self.table.select(
            *self.features,
            *[
                F.try_divide(f"{t}__sum", f"{t}__n").alias(prediction(t))
                for t in self.targets
            ],
        )
        scored = rows.join(known, list(self.features), "left")
        return scored.withColumns(
            {prediction(t): F.coalesce(prediction(t), overall[t]) for t in self.targets}
        )

    def save(self, folder: str) -> None:
        self.table.write.mode("overwrite").parquet(f"{folder}/climatology")


def fit_climatology(df: DataFrame, targets: Sequence[str]) -> Climatology:
    sums = [F.sum(t).cast("double").alias(f"{t}__sum") for t in targets]
    counts = [F.count(t).alias(f"{t}__n") for t in targets]
    table = df.groupBy("month", "is_weekend").agg(*sums, *counts)
    return Climatology(materialise(table, "climatology"), tuple(targets))


def load_climatology(
    folder: str, targets: Sequence[str], features: Sequence[str] = Climatology.features
) -> Climatology:
    """What `Climatology.save` wrote. It has features of its own, whatever others a model would take."""
    return Climatology(SparkSession.active().read.parquet(f"{folder}/climatology"), tuple(targets))


@dataclass(frozen=True)
class Family:
    """One kind of model: `fit(rows, features, targets)` and `load(folder, targets, features)`."""

    fit: Callable[[DataFrame, Sequence[str], Sequence[str]], Predictor]
    load: Callable[[str, Sequence[str], Sequence[str]], Predictor]


def tree_family(**training) -> Family:
    """Gradient-boosted trees, trained with these options."""
    return Family(lambda df, features, targets: train_models(df, features, targets, **training), load_models)


CLIMATOLOGY = Family(lambda df, features, targets: fit_climatology(df, targets), load_climatology)


def predict_batch(model: Predictor, df: DataFrame) -> DataFrame:
    """Predictions for every row, computed once per distinct feature row and joined back.

    The scored combinations are a written table, so the planner broadcasts them by their true size.
    """
    features = list(model.features)
    scored = model.score(combinations(df, features)).drop("rows")
    keep = [*features, *[prediction(t) for t in model.targets]]
    return df.join(materialise(scored.select(*keep), "scored"), features, "left")
