"""Versions of an artifact under one folder; the last one that was written whole is in force.

A version is written to a folder of its own, and one row that points to it is appended after that. What fails
on the way leaves a folder that nothing points to, so the version before stays in force.
"""

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_POINTERS = "version int, path string"


@dataclass(frozen=True)
class Version:
    number: int
    path: str


@dataclass(frozen=True)
class Versions:
    """One publisher at a time; any number of readers."""

    spark: SparkSession
    folder: str

    def history(self) -> DataFrame:
        """`(version, path)` of every version that was published."""
        try:
            return self.spark.read.schema(_POINTERS).parquet(f"{self.folder}/published")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], _POINTERS)

    def current(self) -> Version | None:
        """The version in force, if any was published."""
        row = self.history().orderBy(F.desc("version")).first()
        return None if row is None else Version(row.version, f"{self.folder}/{row.path}")

    def publish(self, save: Callable[[str], object]) -> Version:
        """Let `save` write a new version to the path it is given, then put that in force."""
        before = self.current()
        number = 1 if before is None else before.number + 1
        path = f"versions/{number}-{uuid.uuid4().hex}"
        save(f"{self.folder}/{path}")
        pointer = self.spark.createDataFrame([(number, path)], _POINTERS).coalesce(1)
        pointer.write.mode("append").parquet(f"{self.folder}/published")
        return Version(number, f"{self.folder}/{path}")
