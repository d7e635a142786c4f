"""Quality classifier: random-indexing word vectors, a small network, calibrated.

Word vectors. Every unit has a sparse random index vector that follows from its hash; the
vector of a unit is the sum of the index vectors of the units within ``REACH`` places,
over all documents. Units share ``SLOTS`` hashed slots, so the table has a fixed size
however large the corpus, and each task adds up its own table before anything is shuffled.
There are two kinds of units: words, and shapes of words (``a`` for lower case, ``A`` for
upper case, ``9``, symbols as they are, runs as one sign; whether the word before was the
same).

A document is the mean and the spread of its words' vectors and the mean of its shapes'
index vectors, over its whole text. A two-layer network in numpy learns from these vectors
of at most ``TRAIN_ROWS`` labelled rows, the ones with the smallest hashes of their ids; a
fifth of them is held back to set a temperature, by which the network's scores become
probabilities.

Defined results: a null or empty text is the vector of zeros and gets the score the network
gives that; with no labelled rows at all, or of one class only, every score is the share of
class 1 among them (1 without any). Rows that repeat are scored alike. Further columns are
carried along; a column that clashes with a new one is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from encore.llm.common import arrow_map, batch_of, fold, logistic, one_label, take_column
from encore.llm.textarrays import Slice, Words, hashes, mix, slices, words

SLOTS = 1 << 14
DIMS = 32
REACH = 2
TRAIN_ROWS = 40_000
THRESHOLD = 0.3
FOLDS = 5
STEP = 1 << 20

_SIGN = np.arange(256, dtype=np.uint8)
_SIGN[ord("a") : ord("z") + 1] = ord("a")
_SIGN[ord("A") : ord("Z") + 1] = ord("A")
_SIGN[ord("0") : ord("9") + 1] = ord("9")
_SIGN[0x80:] = ord("a")


def units(s: Slice) -> tuple[Words, np.ndarray, np.ndarray]:
    """The words, their hashed slots without regard to case, and the hashes of their shapes."""
    w = words(s.lower())
    sign = _SIGN[s.data]
    keep = np.ones(len(sign), bool)
    keep[1:] = sign[1:] != sign[:-1]
    keep[w.start] = True
    place = np.concatenate([[0], np.cumsum(keep)])
    shape = hashes(sign[keep], place[w.start], place[w.end])
    again = np.zeros(len(shape), bool)
    again[1:] = (w.hash[1:] == w.hash[:-1]) & (w.row[1:] == w.row[:-1])
    return w, (w.hash % np.uint64(SLOTS)).astype(np.int64), np.where(again, mix(shape), shape)


def index_places(slot: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Two (dimension, sign) pairs for each slot: its random index vector."""
    bits = mix(slot.astype(np.uint64) + np.uint64(1))
    return [
        ((bits >> np.uint64(8 * k)) % np.uint64(DIMS), ((bits >> np.uint64(40 + k)) & np.uint64(1)).astype(float) * 2 - 1)
        for k in (0, 1)
    ]


_PLACES = index_places(np.arange(SLOTS))
_DIM = [d.astype(np.int64) for d, _ in _PLACES]
_PLUS = [p for _, p in _PLACES]


def _accumulate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(SLOTS * DIMS)
    seen = np.zeros(SLOTS)
    for batch in batches:
        for s in slices(take_column(batch, "text"), STEP):
            w, slot, _ = units(s)
            seen += np.bincount(slot, minlength=SLOTS)
            for o in range(1, REACH + 1):
                near = np.flatnonzero(w.row[o:] == w.row[:-o])
                for one, other in ((slot[near], slot[near + o]), (slot[near + o], slot[near])):
                    for dim, plus in zip(_DIM, _PLUS, strict=True):
                        total += np.bincount(one * DIMS + dim[other], weights=plus[other], minlength=SLOTS * DIMS)
    at = np.flatnonzero(seen)
    if len(at):
        rows = total.reshape(SLOTS, DIMS)[at]
        yield batch_of(
            slot=at, seen=seen[at].astype(np.int64), **{f"v{d}": rows[:, d].astype(np.int64) for d in range(DIMS)}
        )


def word_vectors(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(vectors of all slots, their weights in a mean): at most SLOTS rows come to the driver."""
    names = ["seen", *[f"v{d}" for d in range(DIMS)]]
    schema = "slot long, " + ", ".join(f"{n} long" for n in names)
    summed = docs.select("text").mapInArrow(_accumulate, schema).groupBy("slot")
    rows = summed.agg(*[F.sum(n).alias(n) for n in names]).toArrow()
    table, seen = np.zeros((SLOTS, DIMS), np.float32), np.zeros(SLOTS)
    if rows.num_rows:
        at = rows.column("slot").to_numpy()
        seen[at] = rows.column("seen").to_numpy()
        table[at] = np.column_stack([rows.column(n).to_numpy() for n in names[1:]])
    norm = np.linalg.norm(table, axis=1, keepdims=True)
    table = (table / np.maximum(norm, 1e-9)).astype(np.float32)
    share = seen / max(seen.sum(), 1)
    return table, (1e-3 / (1e-3 + share)).astype(np.float32)


def _sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of the rows of ``values`` between consecutive bounds."""
    out = np.zeros((len(first) - 1, values.shape[1]), np.float64)
    some = np.flatnonzero(np.diff(first))
    if len(some):
        out[some] = np.add.reduceat(values, first[:-1][some], axis=0)
    return out


def pool(s: Slice, table: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """One vector per text."""
    w, slot, shape = units(s)
    vectors = table[slot] * weight[slot][:, None]
    n = np.maximum(np.diff(w.first), 1)[:, None]
    mean = _sums(vectors, w.first) / n
    spread = np.sqrt(np.maximum(_sums(vectors * vectors, w.first) / n - mean * mean, 0))
    kinds, of = np.unique(shape, return_inverse=True)
    signs = (kinds[:, None] * mix(np.arange(1, DIMS + 1, dtype=np.uint64))[None, :]) >> np.uint64(63)
    shapes = _sums((signs.astype(np.float32) * 2 - 1)[of], w.first) / n
    return np.hstack([mean, spread, shapes, np.log1p(np.diff(w.first))[:, None] / 10])


class Network:
    """Input, a hidden layer of rectified units, one output; trained with Adam."""

    def __init__(self, x: np.ndarray, y: np.ndarray, hidden: int = 32, epochs: int = 40, seed: int = 7):
        self.shift, self.scale = x.mean(0), x.std(0) + 1e-6
        dice = np.random.default_rng(seed)
        self.layers = [
            dice.normal(0, np.sqrt(2 / x.shape[1]), (x.shape[1], hidden)), np.zeros(hidden),
            dice.normal(0, np.sqrt(2 / hidden), (hidden, 1)), np.zeros(1),
        ]
        self.temperature = 1.0
        first, second = [np.zeros_like(p) for p in self.layers], [np.zeros_like(p) for p in self.layers]
        z, step = self._standard(x), 0
        for epoch in range(epochs):
            rate = 3e-3 * (1 - epoch / epochs) + 1e-4
            for rows in np.array_split(dice.permutation(len(x)), max(1, len(x) // 128)):
                step += 1
                a, b, c, d = self.layers
                h = np.maximum(z[rows] @ a + b, 0)
                error = (logistic((h @ c + d)[:, 0]) - y[rows])[:, None] / len(rows)
                back = (error @ c.T) * (h > 0)
                slopes = [z[rows].T @ back + 1e-4 * a, back.sum(0), h.T @ error + 1e-4 * c, error.sum(0)]
                for p, g, m, v in zip(self.layers, slopes, first, second, strict=True):
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)

    def _standard(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.shift) / self.scale, -8, 8)

    def logits(self, x: np.ndarray) -> np.ndarray:
        a, b, c, d = self.layers
        return (np.maximum(self._standard(x) @ a + b, 0) @ c + d)[:, 0]

    def calibrate(self, x: np.ndarray, y: np.ndarray) -> None:
        """The temperature with the least log loss on rows the network has not seen."""
        logits = self.logits(x)

        def loss(t: float) -> float:
            p = np.clip(logistic(logits / t), 1e-9, 1 - 1e-9)
            return -(y * np.log(p) + (1 - y) * np.log(1 - p)).mean()

        self.temperature = min(np.exp(np.linspace(-1.5, 3, 91)), key=loss)

    def score(self, x: np.ndarray) -> np.ndarray:
        return logistic(self.logits(x) / self.temperature)


class Constant:
    """The model where there is nothing to tell classes apart."""

    def __init__(self, share: float):
        self.share = share

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.full(len(x), self.share)


def fit(docs: DataFrame, labels: DataFrame, learn: Column, table: np.ndarray, weight: np.ndarray):
    """A model from at most TRAIN_ROWS of the labelled documents for which ``learn`` holds."""
    sample = one_label(labels, "quality").filter(learn).orderBy(F.xxhash64("doc_id")).limit(TRAIN_ROWS)
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")

    def job(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for s in slices(take_column(batch, "text"), STEP):
            x = pool(s, table, weight).astype(np.float32)
            part = batch.slice(s.first, len(s))
            yield batch_of(
                doc_id=take_column(part, "doc_id"), y=take_column(part, "y"),
                x=pa.array([r.tobytes() for r in x], pa.binary()),
            )

    # ids are few, but rows that share one may be many
    got = arrow_map(rows, job, "doc_id long, y double, x binary").orderBy(F.xxhash64("doc_id"), "x").limit(TRAIN_ROWS).toArrow()
    y = got.column("y").to_numpy()
    if not len(y) or y.min() == y.max():
        return Constant(float(y.mean()) if len(y) else 1.0)
    x = np.array([np.frombuffer(v.as_py(), np.float32) for v in got.column("x")], np.float64)
    order = np.argsort(mix(np.ascontiguousarray(got.column("doc_id").to_numpy()).view(np.uint64)), kind="stable")
    x, y = x[order], y[order]
    back = np.arange(len(y)) % 5 == 0
    if len(set(y[~back])) < 2 or not back.any():
        back[:] = False
    model = Network(x[~back], y[~back])
    if back.any():
        model.calibrate(x[back], y[back])
    return model


def score_quality(docs: DataFrame, labels: DataFrame, learn: Column | None = None) -> DataFrame:
    """All columns of docs, then held_out, score, predicted."""
    held = F.coalesce(fold(F.col("doc_id"), FOLDS) == 0, F.lit(False))
    table, weight = word_vectors(docs)
    model = fit(docs, labels, ~held if learn is None else learn, table, weight)
    plain = docs.drop("held_out", "score", "predicted")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in slices(take_column(batch, "text"), STEP):
                score = model.score(pool(s, table, weight))
                part = batch.slice(s.first, len(s))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(score)], [*part.schema.names, "score"])

    schema = StructType([*plain.schema.fields, StructField("score", DoubleType())])
    scored = plain.mapInArrow(run, schema)
    return scored.select(
        *plain.columns, held.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
