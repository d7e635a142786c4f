"""Benchmark decontamination by size-partitioned MinHash containment search.

A document is contaminated by a test item if it holds at least ``THRESHOLD`` of the item's
distinct 5-word shingles (A-Z lower-cased; an item of fewer words is one shingle).

MinHash compares sets of like size, but items are short and documents long. So items are
partitioned by size, class c holding those of 2^c to 2^(c+1)-1 shingles, and for each class
a document is a row of overlapping windows, three blocks of 2^c shingles wide and a block
apart: whatever is as long as an item of the class lies whole in some window. An item held
to 75 % then has a Jaccard similarity of at least 0.23 with that window, mostly 0.4 or
more. One agreeing minimum of the ``PERMUTATIONS`` makes a candidate, so one in 3,000 is
missed at the worst and far fewer of those held in full. Each candidate is verified by exact
containment in the document's whole shingle set.

Items are searched in blocks of at most ``BLOCK`` items, whose signatures are broadcast:
a size bound by construction. Documents are never shuffled.

Defined results: a null or empty text has no shingles and matches nothing; repeated rows of
either table match as often as they stand there; empty tables give no matches. Other
columns are ignored by ``matches`` and carried along by ``without_contaminated``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.llm.common import arrow_map, batch_of, take_column
from encore.llm.textarrays import Slice, distinct, mix, shingles, slices, words

THRESHOLD = 75  # per cent
PERMUTATIONS = 32
BLOCK = 50_000
BLOCK_BYTES = 64 << 20  # of item texts

_FACTOR = mix(np.arange(1, PERMUTATIONS + 1, dtype=np.uint64)) | np.uint64(1)


class Items:
    """Signatures and shingle sets of a block of items."""

    def __init__(self, ids: list, texts: list[str], threshold: int, times: list[int] | None = None):
        self.threshold = threshold
        self.ids: list = []
        self.times: list[int] = []  # how often each item occurs
        self.sets: list[np.ndarray] = []
        at = 0
        for s in slices(pa.array(texts, pa.string())):
            values, first = shingles(words(s.lower()))
            for a, b in zip(first[:-1], first[1:], strict=True):
                if b > a:
                    self.ids.append(ids[at])
                    self.times.append(times[at] if times else 1)
                    self.sets.append(distinct(values[a:b]))
                at += 1
        size = np.array([len(x) for x in self.sets], np.int64)
        kind = np.floor(np.log2(np.maximum(size, 1))).astype(int)
        #: class -> per permutation the sorted minima with the items they belong to
        self.minima: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        for c in sorted(set(kind.tolist())):
            of = np.flatnonzero(kind == c)
            table = np.array([[(self.sets[i] * f).min() for i in of] for f in _FACTOR])
            order = [np.argsort(row, kind="stable") for row in table]
            self.minima[c] = [(row[o], of[o]) for row, o in zip(table, order, strict=True)]
        self.quick = {c: [_quick(v) for v, _ in rows] for c, rows in self.minima.items()}

    def candidates(self, values: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Distinct (row, item) pairs that agree in a minimum."""
        found = []
        for k, factor in enumerate(_FACTOR if self.minima else []):
            low, block, bounds = values * factor, 1, first
            for c in range(max(self.minima) + 1):
                if 1 << c > block:
                    low, bounds = _halved(low, bounds)
                    block *= 2
                if c not in self.minima:
                    continue
                window = low.copy()
                last = np.repeat(bounds[1:], np.diff(bounds)) - 1
                for step in (1, 2):
                    beside = np.minimum(np.arange(len(low)) + step, last)
                    np.minimum(window, low[beside], out=window)
                hit = np.flatnonzero(self.quick[c][k][_spot(window)])
                minima, of = self.minima[c][k]
                a = np.searchsorted(minima, window[hit], "left")
                b = np.searchsorted(minima, window[hit], "right")
                row = np.searchsorted(bounds, hit, "right") - 1
                n = b - a
                if n.any():
                    item = of[np.repeat(a - np.cumsum(n) + n, n) + np.arange(n.sum())]
                    found.append(np.unique(np.column_stack([np.repeat(row, n), item]), axis=0))
        return np.unique(np.concatenate(found), axis=0) if found else np.empty((0, 2), int)

    def held(self, s: Slice) -> Iterator[tuple[int, int, int]]:
        """(row, item, shingles in common) of all verified pairs."""
        values, first = shingles(words(s.lower()))
        row, own = -1, values[:0]
        for r, item in self.candidates(values, first):
            if r != row:
                row, own = r, distinct(values[first[r] : first[r + 1]])
            wanted = self.sets[item]
            at = np.minimum(np.searchsorted(own, wanted), len(own) - 1)
            common = int((own[at] == wanted).sum())
            if 100 * common >= self.threshold * len(wanted):
                yield int(r), int(item), common


def _spot(values: np.ndarray) -> np.ndarray:
    return (values >> np.uint64(20)).astype(np.uint16)


def _quick(values: np.ndarray) -> np.ndarray:
    table = np.zeros(1 << 16, bool)
    table[_spot(values)] = True
    return table


def _halved(low: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Minima of pairs of neighbouring blocks, pairs starting anew in each row."""
    n = np.diff(bounds)
    half = (n + 1) // 2
    to = np.concatenate([[0], np.cumsum(half)])
    start = np.repeat(bounds[:-1] - 2 * to[:-1], half) + 2 * np.arange(to[-1])
    return (np.minimum.reduceat(low, start) if len(start) else low[:0]), to


def item_blocks(items: DataFrame, threshold: int, block: int = BLOCK) -> Iterator[Items]:
    """Items dealt out so that a block has about half of ``block`` items and of ``BLOCK_BYTES`` at most.

    Equal rows are one item, reported as often as it occurs.
    """
    known = items.filter("text is not null").groupBy("item_id", "text").agg(F.count("*").alias("times"))
    number, size = known.agg(F.count("*"), F.sum(F.octet_length("text"))).first()
    parts = max(1, -(-number // (block // 2 or 1)), -(-(size or 0) // (BLOCK_BYTES // 2)))
    for part in range(parts):
        rows = known.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part).collect()
        yield Items([r.item_id for r in rows], [r.text for r in rows], threshold, [r.times for r in rows])


def _matches(docs: DataFrame, block: Items) -> DataFrame:
    def job(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        ids = take_column(batch, "doc_id")
        for s in slices(take_column(batch, "text")):
            found = list(block.held(s))
            found = [pair for pair in found for _ in range(block.times[pair[1]])]
            if found:
                row, item, common = map(list, zip(*found, strict=True))
                size = [len(block.sets[i]) for i in item]
                yield batch_of(
                    doc_id=ids.take(pa.array([s.first + r for r in row])),
                    item_id=pa.array([block.ids[i] for i in item], pa.int64()),
                    n_shared=pa.array(common, pa.int64()),
                    n_item=pa.array(size, pa.int64()),
                    containment=pa.array([c / n for c, n in zip(common, size, strict=True)]),
                )

    schema = "doc_id long, item_id long, n_shared long, n_item long, containment double"
    return arrow_map(docs.select("doc_id", "text"), job, schema)


def matches(docs: DataFrame, items: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """doc_id, item_id, n_shared, n_item, containment of every contaminated pair."""
    found = [_matches(docs, block) for block in item_blocks(items, threshold)]
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def without_contaminated(docs: DataFrame, items: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """The documents that hold no item."""
    for block in item_blocks(items, threshold):
        docs = docs.mapInArrow(_keeper(block), docs.schema)
    return docs


def _keeper(block: Items) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            clean = np.ones(batch.num_rows, bool)
            for s in slices(take_column(batch, "text")):
                for row, _, _ in block.held(s):
                    clean[s.first + row] = False
            yield batch.filter(pa.array(clean))

    return run
