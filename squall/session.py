"""Session settings the library relies on."""

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}
# Only at session start. Wide tables build thousands of column expressions; recording a call site for
# each costs more than the rest of the planning.
START_SETTINGS = SETTINGS | {"spark.python.sql.dataFrameDebugging.enabled": "false"}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings to an existing session."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cpus: int | str = "*", partitions: int = 8) -> SparkSession:
    """Local session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("squall")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
    )
    for key, value in START_SETTINGS.items():
        builder = builder.config(key, value)
    spark = configure(builder.getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark
