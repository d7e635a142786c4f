"""Stored tables laid out for joins on one column and scans on another."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from encore.schemas import TABLES
from encore.sinks.store import TableStore


def bucket_of(dist: str, buckets: int) -> Column:
    """The bucket Spark writes a row to."""
    return F.pmod(F.hash(F.col(dist)), F.lit(buckets))


def bucket_skew(df: DataFrame, dist: str, buckets: int) -> float:
    """Rows of the largest bucket over the mean rows per bucket; 0 for no rows."""
    sizes = df.groupBy(bucket_of(dist, buckets).alias("_bucket")).agg(F.count("*").alias("_rows"))
    worst = sizes.agg((F.max("_rows") * buckets / F.sum("_rows")).alias("skew")).first()["skew"]
    return worst or 0.0


def write_layout(
    df: DataFrame, name: str, path: str, dist: str, buckets: int, sort: str | None = None, mode: str = "overwrite"
) -> None:
    """Save ``df`` as table ``name``, bucketed by ``dist`` and sorted by ``sort`` in each file.

    Tables with the same buckets join on ``dist`` without an exchange. Rows are
    gathered by bucket before the write, else every task would write a file per
    bucket; the rebalance hint lets AQE split a bucket that a hot key fills
    over several tasks, which then write several files of that bucket. With ``mode`` append
    the buckets get more files.
    """
    gathered = df.withColumn("_bucket", bucket_of(dist, buckets)).hint("rebalance", "_bucket")
    writer = gathered.drop("_bucket").write.mode(mode).format("parquet")
    writer = writer.bucketBy(buckets, dist)
    if sort is not None:
        writer = writer.sortBy(sort)
    writer.option("path", path).saveAsTable(name)


def read_layout(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


# Properties of a layout: the inserts it holds, and whether a write of more was not finished.
HOLDS = "encore.holds"
UNFINISHED = "encore.unfinished"


def lay_out(store: TableStore, buckets: int, database: str) -> list[str]:
    """Bring the bucketed tables of ``database`` up to date: one for every table that declares a distribution.

    Only inserts that a layout does not hold yet are added to it. It is written anew where rows
    it holds are gone, the number of buckets is another, a write was broken off, or its buckets are
    in more than ``MOST_INSERTS`` pieces.

    A database holds the layouts of one store: files go next to its tables, and saving
    those of another store under the same name is refused. Returns the names of the tables.
    """
    spark = store.spark
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    saved = []
    for table in TABLES.values():
        if table.dist is None:
            continue
        name = f"{database}.{table.name}"
        path = f"{store.root}/laid_out_{table.name}"
        parts = store.parts(table.name)
        there = spark.catalog.tableExists(name)
        if there and not _location(spark, name).endswith(path.partition(":")[2] or path):
            raise ValueError(f"{name} is the layout of another store")
        facts = _properties(spark, name) if there else {}
        held = [p for p in facts.get(HOLDS, "").split(",") if p]
        grows = (
            there and HOLDS in facts and UNFINISHED not in facts and facts.get("buckets") == str(buckets)
            and set(held) <= set(parts) and len(parts) <= MOST_INSERTS
        )
        more = [p for p in parts if p not in held] if grows else parts
        if grows and not more:
            saved.append(name)
            continue
        if grows:
            _set_properties(spark, name, {UNFINISHED: "yes"})
            write_layout(store.read(table.name, more), name, path, table.dist, buckets, table.sort, "append")
        else:
            write_layout(store.read(table.name, parts), name, path, table.dist, buckets, table.sort)
        _set_properties(spark, name, {HOLDS: ",".join(parts)})
        if grows:
            spark.sql(f"ALTER TABLE {name} UNSET TBLPROPERTIES ('{UNFINISHED}')")
        saved.append(name)
    return saved


MOST_INSERTS = 16


def _location(spark: SparkSession, name: str) -> str:
    rows = spark.sql(f"DESCRIBE FORMATTED {name}").where("col_name = 'Location'")
    return rows.first()["data_type"].rstrip("/")


def _properties(spark: SparkSession, name: str) -> dict[str, str]:
    """The table's properties, and its number of ``buckets``."""
    found = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    rows = spark.sql(f"DESCRIBE FORMATTED {name}").where("col_name = 'Num Buckets'").first()
    return found | ({"buckets": rows["data_type"]} if rows else {})


def _set_properties(spark: SparkSession, name: str, facts: dict[str, str]) -> None:
    listed = ", ".join(f"'{k}' = '{v}'" for k, v in facts.items())
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({listed})")


def read_tables(store: TableStore, database: str | None = None) -> dict[str, DataFrame]:
    """The stored tables by name, from those layouts in ``database`` that hold the same inserts."""
    spark, current = store.spark, set()
    if database is not None:
        for table in spark.catalog.listTables(database):
            name = f"{database}.{table.name}"
            if not table.isTemporary and table.name in TABLES and _location(spark, name).startswith(_plain(spark, store.root)):
                facts = _properties(spark, name)
                held = [p for p in facts.get(HOLDS, "").split(",") if p]
                if HOLDS in facts and UNFINISHED not in facts and set(held) == set(store.parts(table.name)):
                    current.add(table.name)
    return {
        name: read_layout(spark, f"{database}.{name}") if name in current else store.read(name)
        for name in TABLES
    }


def _plain(spark: SparkSession, path: str) -> str:
    """The path with its file system, as the catalog shows locations."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(target).toString()
