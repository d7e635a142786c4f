"""Session settings the jobs are tuned for.

On a cluster bring your own session; nothing in the package depends on these
values for right results, the session time zone included.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

# AQE picks broadcast joins from measured sizes, splits skewed join partitions
# and coalesces small shuffle partitions.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # hash join instead of sorting where every partition was measured to be smaller
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cpus: int | str = 8, **extra: str) -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("encore")
    settings = {
        **DEFAULTS,
        # Small data: keep all cores busy, and keep compiled plans between queries.
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
        "spark.sql.codegen.cache.maxEntries": "1000",
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        "spark.sql.shuffle.partitions": str(cpus),
        "spark.driver.memory": "16g",
        **extra,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
