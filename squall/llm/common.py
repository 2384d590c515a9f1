"""What the operators share: words, tables, folds and groups of documents."""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from squall.session import configure

SPACES = r"[\x20\x09-\x0D]+"  # what separates words


BATCH_ROWS = "1000"  # sent to Python workers at once; texts can be long


def prepared(spark: SparkSession) -> SparkSession:
    """The session as the operators use it."""
    configure(spark).conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """Words of a text as an array; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACES), "")


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo `folds`; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def in_fold(doc_id: Column, folds: int, rest: int) -> Column:
    """Whether the id falls in the fold `rest`; a null id never does."""
    return F.coalesce(fold(doc_id, folds) == rest, F.lit(False))


def sha256_hex(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def total_bytes(docs: DataFrame) -> int:
    """Bytes of all texts: one number, from a pass that stays in the JVM."""
    return docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0


def grouped(docs: DataFrame, group_bytes: int, size: int) -> DataFrame:
    """`(g, doc_id, text)`: documents dealt evenly to groups that a task can hold.

    `text` is binary, null becoming empty; `size` is the bytes of all texts. The group depends on
    id and text, so a lost task is recomputed alike and a null or repeated id is no hot group.
    """
    count = max(2 * partitions(docs.sparkSession), size // group_bytes + 1)
    text = F.coalesce(F.col("text"), F.lit("")).alias("text")
    rows = docs.select(F.col("doc_id"), text)
    g = F.pmod(F.xxhash64("doc_id", "text"), F.lit(count)).cast("int").alias("g")
    return rows.select(g, "doc_id", F.col("text").cast("binary").alias("text"))


def in_order(group: pa.Table) -> pa.Table:
    """Rows of a group in an order that every pass repeats; only equal rows may change places."""
    return group.sort_by([("doc_id", "ascending"), ("text", "ascending")])


def buffer_of(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All texts of a binary column end to end, and where each begins (plus the end)."""
    texts = column.to_pylist()
    begins = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(t) for t in texts], out=begins[1:])
    return np.frombuffer(b"".join(texts), dtype=np.uint8), begins
