"""The corpus pipeline: stages over `documents`, each on all that the one before kept."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from squall.llm import decontaminate, language, mixing, pii, simhash
from squall.llm.common import prepared, table
from squall.storage import materialise


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a language: null texts and texts without a letter.

    Without any labelled text no language is learned; all other documents stay then as well.
    """
    prepared(spark)
    model = language.train(docs)
    if not model.names:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    rows = docs.select(F.struct("*").alias("row"), language.predictor(model)("text").alias("p"))
    return rows.filter(F.col("p.lang_pred") != language.NONE).select("row.*")


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near duplicates, the one with the smallest id.

    Texts without words are near duplicates of each other. A null id is larger than any; of equal rows one stays.
    """
    prepared(spark)
    return simhash.deduplicate(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts benchmark passages out of the texts and drops texts that are mostly benchmark.

    Null texts and texts without words have no passage and stay, as all do beside an empty benchmark; equal
    rows are treated alike.
    """
    prepared(spark)
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by its kind in brackets.

    Null and empty texts stay as they are; equal rows are treated alike, each for itself.
    """
    prepared(spark)
    return pii.mask_personal_data(docs)


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row, text included, for every time the mix takes a document, in training order.

    Documents without words are never taken; a null source is a source of its own; equal positions are ordered
    by id; equal rows are taken each for itself.
    """
    prepared(spark)
    return mixing.training_set(docs)


STAGES = [
    ("language_id", language_id),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("personal_data", personal_data),
    ("mixing_sources", mixing_sources),
]

# SQL tells neither language mixtures nor fingerprints; a test holds all rows of the run against a version
# in plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written to the shared folder and read again."""
    docs = table(prepared(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
