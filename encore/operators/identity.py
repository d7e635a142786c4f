"""Generated surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from encore.scratch import stage


def with_offsets(
    df: DataFrame, order_cols: Sequence[str], width: str, offset_col: str, range_col: str
) -> tuple[DataFrame, str]:
    """Distinct rows with the sum of ``width`` over all rows before them in the given order.

    Where a row stands for ``width`` ids, the offset is the first of them: ids without
    gaps, given out without sorting what the rows will become. ``range_col`` numbers the
    ranges of the order that the rows were dealt to, which a later step may write by.

    A range shuffle and running sums inside each range replace a global window. ``df``
    must be distinct on ``order_cols``, so that no rows tie and a rerun gives the same
    offsets whatever the ranges are.

    The dealt rows are written once to the shared folder, which fixes their ranges even if
    executors are lost later. Returns the rows and the path of the written ones, for
    ``scratch.discard`` after use.
    """
    dealt = df.repartitionByRange(*order_cols).withColumn(range_col, F.spark_partition_id())
    staged, path = stage(dealt, "identity")
    # One row per shuffle partition, whatever the data: safe to order in one
    # task and to broadcast.
    sizes = staged.groupBy(F.col(range_col).alias("_part")).agg(F.sum(width).alias("_width"))
    ahead = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_width").over(ahead), F.lit(0)).alias("_start"))
    inside = Window.partitionBy(range_col).orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, -1)
    placed = staged.withColumn("_before", F.coalesce(F.sum(width).over(inside), F.lit(0)))
    joined = placed.join(F.broadcast(starts), F.col(range_col) == F.col("_part"))
    return joined.withColumn(offset_col, F.col("_start") + F.col("_before")).drop("_part", "_start", "_before"), path
