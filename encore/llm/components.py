"""Connected components of a graph given as edges, by alternating large and small stars.

A large star hangs a node's larger neighbours onto its smallest neighbour, a small star
does so with the node and its smaller ones. Each round is two grouped minima and joins;
nothing is gathered per node, so a node of any degree is spread by the joins (AQE splits
skewed sides). The edges shrink to one per node, and after a logarithmic number of rounds
every node hangs on the smallest of its component. Rounds are written to the shared folder,
which cuts lineage.

Before that, parts of at most ``LOCAL`` edges are each brought to stars by one task. A graph
of no more edges than that is one part and done.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.llm.common import batch_of, whole_partition
from encore.scratch import stage

LOCAL = 1_000_000


def join_groups(group: np.ndarray, one: np.ndarray, two: np.ndarray) -> None:
    """Gives both places of each pair, and all that is grouped with them, the smallest group."""
    while True:
        a, b = group[one], group[two]
        apart = a != b
        if not apart.any():
            return
        into = np.arange(len(group))
        np.minimum.at(into, np.maximum(a, b)[apart], np.minimum(a, b)[apart])
        while not np.array_equal(further := into[into], into):
            into = further
        group[:] = into[group]


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The edges (high, low) of a partition as stars around the smallest nodes."""
    table = whole_partition(batches)
    if table is None:
        return
    high, low = table.column("high").to_numpy(), table.column("low").to_numpy()
    nodes, at = np.unique(np.concatenate([high, low]), return_inverse=True)
    group = np.arange(len(nodes))
    join_groups(group, at[: len(high)], at[len(high) :])
    outer = np.flatnonzero(group != np.arange(len(nodes)))
    yield batch_of(high=nodes[outer], low=nodes[group[outer]])


def _hang(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("low").alias("high"), F.col("high").alias("low")))
    best = both.groupBy("high").agg(F.min("low").alias("best"))
    large = (
        both.join(best, "high")
        .filter("low > high")
        .select(F.col("low").alias("high"), F.least("best", "high").alias("low"))
        .distinct()
    )
    best = large.groupBy("high").agg(F.min("low").alias("best"))
    small = large.join(best, "high")
    return (
        small.filter("low != best")
        .select(F.col("low").alias("high"), F.col("best").alias("low"))
        .unionByName(best.withColumnRenamed("best", "low"))
        .distinct()
    )


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of all nodes in edges (a, b); a component's name is its smallest node."""
    ends = edges.filter("a != b").select(F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low"))
    first, _ = stage(ends, "edges", gathered=True)
    parts = max(1, -(-first.count() // LOCAL))
    # several parts are dealt by both ends, so that a node of any degree is dealt out
    dealt = first.repartition(parts, "high", "low") if parts > 1 else first.repartition(1)
    now, _ = stage(dealt.mapInArrow(_stars, "high long, low long"), "edges")
    state = None
    while parts > 1:
        was, state = state, now.agg(F.count("*"), F.sum(F.xxhash64("high", "low") % 1_000_003)).first()
        if was == state:
            break
        now, _ = stage(_hang(now), "edges")
    roots = now.select(F.col("low").alias("node")).distinct()
    return now.select(F.col("high").alias("node"), F.col("low").alias("component")).unionByName(
        roots.withColumn("component", F.col("node"))
    )
