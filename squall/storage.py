"""Tables written between steps.

A written table cuts lineage (a lost executor re-reads files instead of recomputing the plan)
and gives the planner the table's true size, so it broadcasts only what is really small.
"""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"

_local_folders: dict[str, str] = {}  # local sessions without that setting, as in tests


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it."""
    folder = spark.conf.get(CHECKPOINT_DIR, None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder shared by all executors")
    if context.applicationId not in _local_folders:
        _local_folders[context.applicationId] = tempfile.mkdtemp(prefix="squall-")
    return _local_folders[context.applicationId]


def scratch_path(spark: SparkSession, label: str) -> str:
    """Fresh path under the shared folder; nothing is ever overwritten or removed."""
    app = spark.sparkContext.applicationId
    return f"{shared_dir(spark)}/squall/{app}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write `df` to the shared folder and return the written table."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
