"""Sums of arrays of counts over all tasks.

Every task sums its own part and sends one packed row. A few tasks add these rows up, and the driver gets one array
from each: its size is that of the array, whatever the corpus.
"""

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from squall.llm.packed import pack, unpack

ADDERS = 16  # tasks that add up, and arrays that reach the driver

PACKED = "counts binary"


def row(counts: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([pack(counts.astype("<i8"))], pa.binary())], names=["counts"])


def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = None
    for batch in batches:
        for one in batch["counts"]:
            counts = unpack(one.as_py(), "<i8")
            total = counts.copy() if total is None else total + counts
    if total is not None:
        yield row(total)


def summed(rows: DataFrame, count: Callable[[Iterator[pa.RecordBatch]], np.ndarray], size: int) -> np.ndarray:
    """Sum of `count(batches)`, `size` numbers, over the partitions of `rows`; zeros if there are none."""

    def of_part(batches):
        yield row(count(batches))

    parts = rows.mapInArrow(of_part, PACKED).repartition(ADDERS).mapInArrow(add_up, PACKED)
    total = np.zeros(size, dtype=np.int64)
    for one in parts.collect():
        total += unpack(bytes(one.counts), "<i8")
    return total
