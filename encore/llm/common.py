"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of text that a task works on at once.
ARROW_ROWS = 2000
#: A word, for Java's regular expressions.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, all other characters as they are."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def arrow_map(
    df: DataFrame, job: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema: str
) -> DataFrame:
    """``job`` on each Arrow batch, without state between batches, in parts of ARROW_ROWS rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ARROW_ROWS):
                yield from job(batch.slice(at, ARROW_ROWS))

    return df.mapInArrow(run, schema)


def batch_of(**columns) -> pa.RecordBatch:
    """A record batch of numpy arrays, Arrow arrays or lists."""
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c) for c in columns.values()], names=list(columns)
    )


def packed(rows: list[np.ndarray]) -> pa.Array:
    """Each array's bytes as one binary value."""
    return pa.array([r.tobytes() for r in rows], pa.binary())


def whole_partition(batches: Iterator[pa.RecordBatch]) -> pa.Table | None:
    """All rows of a partition; only for partitions of a proven size."""
    got = [b for b in batches if b.num_rows]
    return pa.Table.from_batches(got).combine_chunks() if got else None


def numpy_of(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy()


def ddl(df: DataFrame) -> str:
    """The columns of ``df`` as a schema string."""
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


#: Rows of (doc_id, one small number) that may be broadcast: about 160 MB.
BROADCAST_ROWS = 10_000_000


def bounded_broadcast(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` to be broadcast if it is counted to be small, else as it is, for a shuffled join."""
    return F.broadcast(df) if df.count() <= rows else df


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; of a missing id none."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def one_label(labels: DataFrame, column: str) -> DataFrame:
    """(doc_id, y): one row per labelled document; the larger of contradicting labels."""
    return (
        labels.filter(f"doc_id is not null and {column} is not null")
        .groupBy("doc_id")
        .agg((F.max(column) > 0).cast("double").alias("y"))
    )


def take_column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 100) -> np.ndarray:
    """Weights of a ridge logistic regression by damped Newton steps; the last is the constant.

    Columns are brought to one scale for the fit, and steps that don't lower the loss are halved.
    """
    shift, scale = x.mean(0), x.std(0) + 1e-9
    z = np.column_stack([(x - shift) / scale, np.ones(len(x))])
    penalty = ridge * np.append(np.ones(x.shape[1]), 1e-6)

    def loss(w: np.ndarray) -> float:
        at = z @ w
        return np.logaddexp(0, at).sum() - y @ at + (penalty * w * w).sum() / 2

    w, now = np.zeros(z.shape[1]), np.inf
    for _ in range(steps):
        p = logistic(z @ w)
        bend = (z.T * (p * (1 - p))) @ z + np.diag(penalty)
        move = np.linalg.solve(bend, z.T @ (p - y) + penalty * w)
        size = 1.0
        while size > 1e-6 and loss(w - size * move) > now:
            size /= 2
        if size <= 1e-6:
            break
        w = w - size * move
        was, now = now, loss(w)
        if was - now < 1e-9:
            break
    return np.append(w[:-1] / scale, w[-1] - (w[:-1] / scale) @ shift)


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The 64-bit values of a column made by ``packed``, back to back, and where each row begins."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = b"" if data is None else data.slice(offsets[0], offsets[-1] - offsets[0]).to_pybytes()
    return np.frombuffer(data, np.uint64), (offsets - offsets[0]) // 8
