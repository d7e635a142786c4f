"""Words, lines and shingles of Arrow text columns as flat numpy arrays.

Texts are taken whole. A column is worked through in slices of whole texts of about
``STEP`` bytes, so that memory follows the longest text and not the batch.
All separators and the letters A-Z are single bytes that never occur inside a longer
UTF-8 sequence; bytes can therefore stand for characters here.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

STEP = 1 << 20
ROWS = 1 << 19  # most texts in a slice
SHINGLE = 5

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_BASE = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """Scrambles 64-bit values one to one (the finisher of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_PLACE = mix(np.arange(101, 101 + 64, dtype=np.uint64) * _BASE) | np.uint64(1)
#: The lowest k bytes of a number.
_LOWEST = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


@dataclass
class Slice:
    """Some whole texts: rows first..first+n of the column, their bytes back to back."""

    first: int
    data: np.ndarray
    offsets: np.ndarray  # n + 1 of them, from 0

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def lower(self) -> Slice:
        return Slice(self.first, _LOWER[self.data], self.offsets)


def slices(column: pa.Array, step: int = STEP) -> Iterator[Slice]:
    """The texts of a column; a missing text is empty."""
    texts = column.cast(pa.large_string()).fill_null("")
    if not len(texts):
        return
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    at = 0
    while at < len(texts):
        to = int(np.searchsorted(offsets, offsets[at] + step, "right")) - 1
        to = min(max(to, at + 1), at + ROWS, len(texts))
        yield Slice(at, data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at])
        at = to


@dataclass
class Words:
    """Words in order: byte spans, row within the slice, and 64-bit hashes."""

    start: np.ndarray
    end: np.ndarray
    row: np.ndarray
    hash: np.ndarray
    first: np.ndarray  # for each row the number of its first word, and the total at the end


def spans(s: Slice, separator: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of non-separators; runs end where texts end."""
    solid = ~separator[s.data]
    begins = solid.copy()
    begins[1:] &= ~solid[:-1]
    ends = solid.copy()
    ends[:-1] &= ~solid[1:]
    inner = s.offsets[1:-1]
    inner = inner[(inner > 0) & (inner < len(solid))]
    begins[inner] = solid[inner]
    ends[inner - 1] = solid[inner - 1]
    return np.flatnonzero(begins), np.flatnonzero(ends) + 1


def hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, step: int = STEP, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of the bytes of each span; spans ascend and don't overlap.

    The sum of a scrambled value for each eight bytes and their place in the span. No
    polynomial: those modulo 2^64 are equal for some texts whatever the base. Hashes of different
    seeds scramble differently and are independent of each other.
    """
    out = np.empty(len(start), np.uint64)
    mark = mix(np.array([seed], np.uint64) * _BASE + np.uint64(1))[0]
    at = 0
    while at < len(start):
        low = int(start[at])
        to = max(int(np.searchsorted(end, low + step, "right")), at + 1)
        a, b = start[at:to] - low, end[at:to] - low
        padded = np.zeros(int(b[-1]) + 8, np.uint8)
        padded[: b[-1]] = data[low : low + int(b[-1])]
        eight = np.lib.stride_tricks.as_strided(padded[:8].view(np.uint64), (len(padded) - 7,), (1,))  # from any byte
        pieces = np.maximum(b - a + 7, 8) >> 3
        head = np.cumsum(pieces) - pieces
        place = np.arange(int(pieces.sum())) - np.repeat(head, pieces)
        begin = np.repeat(a, pieces) + 8 * place
        value = eight[begin] & _LOWEST[np.clip(np.repeat(b, pieces) - begin, 0, 8)]
        scrambled = mix(mix(value + mark) + (place.astype(np.uint64) + np.uint64(1)) * (mark | np.uint64(1)))
        out[at:to] = mix(np.add.reduceat(scrambled, head) ^ ((b - a).astype(np.uint64) * _BASE + mark))
        at = to
    return out


def words(s: Slice) -> Words:
    start, end = spans(s)
    first = np.searchsorted(start, s.offsets)
    row = np.repeat(np.arange(len(s)), np.diff(first))
    return Words(start, end, row, hashes(s.data, start, end), first)


def shingles(w: Words, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """All shingles in order and where each row's begin (one more at the end).

    A row with fewer words than a shingle has its whole sequence as its only one; a row
    without words has none.
    """
    count = np.diff(w.first)
    n = np.where(count >= size, count - size + 1, (count > 0).astype(count.dtype))
    first = np.concatenate([[0], np.cumsum(n)])
    begin = np.repeat(w.first[:-1] - first[:-1], n) + np.arange(first[-1])
    length = np.repeat(np.minimum(count, size), n)
    out = length.astype(np.uint64) * _BASE
    for k in range(size):
        at = begin + k
        inside = k < length
        part = w.hash[np.minimum(at, max(len(w.hash) - 1, 0))] * _PLACE[k] if len(at) else out[:0]
        out = out + np.where(inside, part, np.uint64(0))
    return mix(out), first


def distinct(values: np.ndarray) -> np.ndarray:
    """The sorted distinct values; np.unique hashes, which takes many times as long."""
    values = np.sort(values)
    new = np.ones(len(values), bool)
    new[1:] = values[1:] != values[:-1]
    return values[new]


def signed(x: np.ndarray) -> np.ndarray:
    """Spark has no unsigned 64-bit type; the bits stay."""
    return np.ascontiguousarray(x).view(np.int64)
