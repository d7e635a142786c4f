"""Exact k-means on integer vectors, by zone maps of vectors in order of a space-filling curve.

A vector takes part if it has exactly ``DIM`` components, none null or not finite. A component
x becomes floor(256 x), cut to +-2^27, so that every squared distance fits a long. Vectors are
then integers and all results exact: the nearest centroid (ties go to the smaller number) and
the componentwise floor(sum / count).

Method:

1. Each vector gets the place of its cell on a Hilbert curve through a grid of ``2 ** BITS``
   cells a side, which spans three standard deviations to both sides of each component's mean.
   A range shuffle by that place deals them out, and each partition cuts its run of the
   curve into blocks of ``BLOCK`` vectors: one row with the matrix and the least and
   largest value of each component, the box. A random salt decides among equal places, so a
   vector that a third of the rows hold is many blocks and not one task.
2. In every round a task compares boxes with the centroids. No vector of a block is nearer to a
   centroid than the box is, nor is the nearest one further than the box's far corner of any
   centroid; centroids whose near bound exceeds the least far bound are out. The vectors of the
   block are compared with the others only, all at once.
3. Tasks add up their vectors per centroid; 40 sums of 64 numbers reach the driver, which makes
   the next centroids. The blocks are written once and read in every round, so a lost
   executor costs tasks of one round.

Defined results: rows that share a vec_id are vectors of their own; where they tie for a
starting place, the smaller vector goes first. A null vec_id is hashed as if it had no digits.
With fewer vectors than ``K`` there are as many centroids as vectors; equal ones leave all but
the first empty. Sums of distances beyond the largest long are that long. Other columns are ignored; an empty table, or one without such vectors, gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.llm.common import arrow_map, batch_of, packed, take_column
from encore.scratch import discard, stage

DIM = 64
K = 40
ROUNDS = 5
SCALE = 256.0
LARGEST = 1 << 27  # DIM * (2 * LARGEST) ** 2 is below 2 ** 63
BITS = 4  # of a component on the curve
BLOCK = 256  # vectors
LONG = (1 << 63) - 1
EXACT = 1 << 22  # up to here products of doubles are exact: DIM * (2 * EXACT) ** 2 is below 2 ** 53


def hilbert(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Places on the Hilbert curve of cells (rows of coordinates below ``2 ** bits``), as rows of bytes.

    The coordinates are turned, from the top bit down, so that each subcube is entered and left
    at neighbouring corners; read crosswise, the bits of a row then count along the curve.
    """
    x = cells.astype(np.int64).T.copy()
    for bit in range(bits - 1, 0, -1):
        low = (1 << bit) - 1
        for k in range(len(x)):
            high = (x[k] >> bit) & 1 == 1
            swap = np.where(high, 0, (x[0] ^ x[k]) & low)
            x[0] ^= np.where(high, low, swap)
            x[k] ^= swap
    for k in range(1, len(x)):
        x[k] ^= x[k - 1]
    flip = np.zeros_like(x[0])
    for bit in range(bits - 1, 0, -1):
        flip ^= np.where((x[-1] >> bit) & 1 == 1, (1 << bit) - 1, 0)
    x ^= flip
    planes = (x[None] >> np.arange(bits - 1, -1, -1)[:, None, None]) & 1
    return np.packbits(planes.reshape(bits * len(x), -1).T.astype(np.uint8), axis=1)


def _rows(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Which rows take part, and their integer vectors."""
    lists = take_column(batch, "embedding")
    size = lists.value_lengths().fill_null(0).to_numpy()
    right = np.flatnonzero(size == DIM)
    if not len(right):
        return right, np.zeros((0, DIM), np.int64)
    values = lists.take(pa.array(right)).flatten().cast(pa.float64())
    x = values.fill_null(np.nan).to_numpy().reshape(-1, DIM)
    fine = np.isfinite(x).all(1)
    whole = np.floor(np.clip(x[fine], -LARGEST / SCALE, LARGEST / SCALE) * SCALE)
    return right[fine], whole.astype(np.int64)


VECTOR = "vec_id long, vector binary"


def kept_vectors(table: DataFrame) -> DataFrame:
    """(vec_id, vector): the vectors that take part, as 32-bit integers."""

    def job(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        rows, x = _rows(batch)
        if len(rows):
            yield batch_of(vec_id=take_column(batch, "vec_id").take(pa.array(rows)), vector=packed(list(x.astype(np.int32))))

    ids = table.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    return arrow_map(ids, job, VECTOR)


def _matrix(column: pa.Array) -> np.ndarray:
    """The 32-bit vectors of a binary column as rows."""
    data = column.cast(pa.large_binary())
    offsets = np.frombuffer(data.buffers()[1], np.int64)[data.offset : data.offset + len(data) + 1]
    return np.frombuffer(data.buffers()[2], np.uint8)[offsets[0] : offsets[-1]].view(np.int32).reshape(-1, DIM)


def _grid(vectors: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Least value and cell size of each component, from its mean and deviation over all vectors."""

    def job(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        if batch.num_rows:
            x = _matrix(take_column(batch, "vector")).astype(np.float64)
            sums = np.concatenate([x.sum(0), (x * x).sum(0)])
            yield batch_of(at=np.arange(2 * DIM), sum=sums, n=np.full(2 * DIM, float(len(x))))

    found = arrow_map(vectors, job, "at long, sum double, n double").groupBy("at").agg(F.sum("sum"), F.sum("n"))
    mean = np.zeros(2 * DIM)
    for at, total, n in found.collect():  # 128 rows
        mean[at] = total / n
    deviation = np.sqrt(np.maximum(mean[DIM:] - mean[:DIM] ** 2, 0)) + 1e-9
    return mean[:DIM] - 3 * deviation, 6 * deviation / (1 << BITS)


def zone_blocks(vectors: DataFrame) -> DataFrame:
    """(vec_ids, n, vectors, low, high): blocks of neighbours on the curve with their boxes."""
    least, cell = _grid(vectors)

    def places(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        if batch.num_rows:
            x = _matrix(take_column(batch, "vector"))
            cells = np.clip((x - least) / cell, 0, (1 << BITS) - 1).astype(np.int64)
            yield batch_of(
                vec_id=take_column(batch, "vec_id"), vector=take_column(batch, "vector"), place=packed(list(hilbert(cells)))
            )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                x = _matrix(take_column(part, "vector"))
                ids = take_column(part, "vec_id")
                yield pa.RecordBatch.from_arrays(
                    [pa.array([ids.to_pylist()], pa.list_(pa.int64())), *(packed([v]) for v in (x, x.min(0), x.max(0)))],
                    names=["vec_ids", "vectors", "low", "high"],
                )

    placed, path = stage(arrow_map(vectors, places, f"{VECTOR}, place binary").withColumn("salt", F.rand(5)), "hilbert")
    ordered = placed.repartitionByRange("place", "salt").sortWithinPartitions("place", "salt").select("vec_id", "vector")
    blocks, _ = stage(ordered.mapInArrow(cut, "vec_ids array<bigint>, vectors binary, low binary, high binary"), "zones")
    discard(vectors.sparkSession, path)
    return blocks


def candidates(low: np.ndarray, high: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Which centroids may be nearest to a vector in the box, for every box: boxes by centroids."""
    low, high = low[:, None].astype(np.int64), high[:, None].astype(np.int64)
    near = np.maximum(np.maximum(low - centroids, centroids - high), 0)
    far = np.maximum(np.abs(centroids - low), np.abs(high - centroids))
    near, far = (near * near).sum(2), (far * far).sum(2)
    return near <= far.min(1, keepdims=True)


def nearest(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid, the smaller on a tie, and its squared distance, exactly."""
    if max(np.abs(x).max(initial=0), np.abs(centroids).max(initial=0)) < EXACT:
        a, b = x.astype(np.float64), centroids.astype(np.float64)
        away = ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)).astype(np.int64)
    else:
        away = np.stack([((x - c) ** 2).sum(1) for c in centroids], 1)
    best = away.argmin(1)
    return best, away[np.arange(len(x)), best]


def _assigned(batch: pa.RecordBatch, centroids: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(row, vectors, cluster, distance) of each block of a batch."""
    open_ = candidates(_matrix(take_column(batch, "low")), _matrix(take_column(batch, "high")), centroids)
    blocks = take_column(batch, "vectors")
    for r in range(batch.num_rows):
        x = _matrix(blocks.slice(r, 1)).astype(np.int64)
        few = np.flatnonzero(open_[r])
        best, away = nearest(x, centroids[few])
        yield r, x, few[best], away


def _moved(blocks: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after a round."""

    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros(centroids.shape, np.int64), np.zeros(len(centroids), np.int64)
        for batch in batches:
            for _, x, cluster, _ in _assigned(batch, centroids):
                order = np.argsort(cluster, kind="stable")
                own, head, many = np.unique(cluster[order], return_index=True, return_counts=True)
                sums[own] += np.add.reduceat(x[order], head)
                counts[own] += many
        own = np.flatnonzero(counts)
        yield batch_of(
            cluster=np.repeat(own, DIM), at=np.tile(np.arange(DIM), len(own)), total=sums[own].ravel(), n=np.repeat(counts[own], DIM)
        )

    parts = blocks.select("vectors", "low", "high").mapInArrow(job, "cluster long, at long, total long, n long")
    moved = centroids.copy()
    for cluster, at, total, n in parts.groupBy("cluster", "at").agg(F.sum("total"), F.sum("n")).collect():
        moved[cluster, at] = total // n  # at most K * DIM rows
    return moved


def _first_centroids(vectors: DataFrame, k: int) -> np.ndarray:
    name = F.concat(F.lit("2:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    components = F.col("vector")
    first = vectors.select(F.sha2(name.cast("binary"), 256).alias("hash"), components).orderBy("hash", "vector").limit(k)
    rows = first.collect()  # at most k
    rows = [(r["hash"], np.frombuffer(r["vector"], np.int32).astype(np.int64).tolist()) for r in rows]
    return np.array([v for _, v in rows], np.int64).reshape(-1, DIM)


RESULT = "vec_id long, cluster int, distance long"


def cluster(table: DataFrame, k: int = K, rounds: int = ROUNDS) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256: one row per vector that takes part."""
    spark = table.sparkSession
    vectors, path = stage(kept_vectors(table), "vectors")
    centroids = _first_centroids(vectors, k)
    blocks = zone_blocks(vectors)
    discard(spark, path)
    for _ in range(rounds):
        centroids = _moved(blocks, centroids)

    def job(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        ids = take_column(batch, "vec_ids")
        for r, _, own, away in _assigned(batch, centroids):
            yield batch_of(vec_id=ids[r].values, cluster=own.astype(np.int32), distance=away)

    found, _ = stage(arrow_map(blocks, job, RESULT), "assigned")
    exact = F.sum(F.col("distance").cast("decimal(19,0)"))
    sums = {r["cluster"]: int(r["all"]) for r in found.groupBy("cluster").agg(exact.alias("all")).collect()}  # at most k
    total = min(sum(sums.values()), LONG)
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    rows = [(c, min(s, LONG), total, names[c]) for c, s in sums.items()]
    facts = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(facts), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
