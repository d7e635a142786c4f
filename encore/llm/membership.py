"""A Bloom filter of bounded size, made in a distributed way."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.llm.common import arrow_map, batch_of
from encore.llm.textarrays import distinct, mix, signed

LEAST_BITS, MOST_BITS = 1 << 20, 1 << 28


class Filter:
    """Says yes to all keys it was made of, and to few others as long as it is not crowded.

    It takes 16 bits a key up to ``MOST_BITS`` (32 MB). Beyond that more other keys get
    through, so whatever uses it has to be right without it.
    """

    def __init__(self, words: np.ndarray):
        self.words = words

    def has(self, keys: np.ndarray) -> np.ndarray:
        one, two = _places(keys, len(self.words) * 64)
        held = [(self.words[b >> 6] >> (b & 63).astype(np.uint64)) & np.uint64(1) for b in (one, two)]
        return (held[0] & held[1]).astype(bool)

    @classmethod
    def of(cls, keys: DataFrame) -> Filter:
        """Of the only column of ``keys``, 64-bit numbers.

        Tasks join their bits to words first; at most MOST_BITS / 64 words reach the driver.
        """
        keys = keys.distinct()
        bits = LEAST_BITS
        count = keys.count()
        while bits < min(16 * count, MOST_BITS):
            bits *= 2

        def job(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            bit = distinct(np.concatenate(_places(batch.column(0).to_numpy(), bits)))
            at, head = np.unique(bit >> 6, return_index=True)
            word = np.bitwise_or.reduceat(np.uint64(1) << (bit & 63).astype(np.uint64), head)
            yield batch_of(at=at, word=signed(word))

        rows = arrow_map(keys, job, "at long, word long").groupBy("at").agg(F.bit_or("word").alias("word")).toArrow()
        words = np.zeros(bits // 64, np.uint64)
        words[rows.column("at").to_numpy()] = np.ascontiguousarray(rows.column("word").to_numpy()).view(np.uint64)
        return cls(words)


def _places(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    keys = np.ascontiguousarray(keys).view(np.uint64)
    mask = np.uint64(bits - 1)
    return (mix(keys) & mask).astype(np.int64), (mix(~keys) & mask).astype(np.int64)
