"""Intermediate tables in the folder that every executor can reach.

Cutting lineage through a written table survives lost executors, and a parquet
table can be read back column by column, which a checkpointed RDD cannot.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_root(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; where it is unset on one machine, a folder below the warehouse.

    On a cluster it has to be set: nothing else is known to be reached by all executors.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.partition("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors reach")
        root = f"{spark.conf.get('spark.sql.warehouse.dir')}/_encore_scratch"
    return root.rstrip("/")


def new_path(spark: SparkSession, label: str) -> str:
    """A path nobody has used yet."""
    return f"{shared_root(spark)}/encore-{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str, gathered: bool = False) -> tuple[DataFrame, str]:
    """Write ``df`` once and return the stored rows with their path.

    ``gathered`` is for rows that are few beside the tasks that make them: AQE packs them into files of
    its advisory size. Otherwise each task writes a file, however small, and for each file on a local
    disk Hadoop without its native library starts a process or more from the executor's JVM.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    (df.hint("rebalance") if gathered else df).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, path: str) -> None:
    """Delete a staged table once nothing reads it any more."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
