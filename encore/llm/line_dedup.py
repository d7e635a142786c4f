"""Line dedup with sharded cuckoo filters over exact reference counts.

A line's key is the line without separators at both ends, A-Z lower-cased. A key of at
least ``MIN_CHARS`` code points that two or more documents hold stays only in the smallest
doc_id of its holders.

Keys are dealt to shards by their hash. A shard keeps

- the exact reference table: one row per key and document (hash, doc_id, number of lines, hash of
  the whole text), from which follow how many documents hold a key and which is the smallest. Hashes
  of keys are 128 bits wide;
- a cuckoo filter of the shard's keys, as one numpy table of 16-bit fingerprints in
  buckets of four. It says "surely new" or "perhaps known". There are as many shards as
  references need at ``SHARD_KEYS`` each, so a shard fits a task whatever the table's size.

A first set of documents goes through the filters too. A map task sends a key to its shard once
for each batch of documents that holds it, so a line that all documents have is a few rows; a key
that two documents of one batch hold is known to repeat. In the shard each key is tested
and then inserted: what the filter has seen perhaps repeats, and only the references of such keys
are grouped, joined and counted. Keys that are surely new, most lines of a corpus, take no further part.

Inserting documents looks their keys up in the filters. Keys that are surely new need no
row of the reference table; only the others are joined with it. Deleting documents takes
their references away; a key without references leaves the filter too, and a key that goes
back to one holder is kept there again. Every insert can thus be undone.

``insert`` and ``delete`` return a new index in a new folder below ``spark.checkpoint.dir``
and leave the old one as it was, so a lost job is repeated from whole tables.

Defined results: a null or empty text is one empty line; a row with a null doc_id holds no
keys and stays as it is; rows that share a doc_id are one holder, and each looks for the keys of its
own text only, so many such rows make no long list; an empty table gives an empty result. ``resolve``
takes the documents as they were inserted. Other columns are carried along; columns named line_count or lines_dropped are
replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from encore.llm.common import arrow_map, batch_of, ddl, take_column
from encore.llm.textarrays import Slice, hashes, mix, signed, slices
from encore.scratch import stage

MIN_CHARS = 10
SLOTS = 4
KICKS = 200
SHARD_KEYS = 2_000_000  # references to a shard, about: 16 MB of hashes in a task
CHUNK = 1 << 16  # keys that a filter takes at once

_STRIP = np.zeros(256, bool)
_STRIP[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


class CuckooFilter:
    """Fingerprints in buckets of ``SLOTS``; all operations take arrays of 64-bit hashes.

    A key is to be inserted once; deleting a key that was never inserted is an error of the
    caller. ``tests`` may say yes wrongly (about 8 in 65536 times the load), never no.
    """

    def __init__(self, table: np.ndarray):
        self.table = table  # (buckets, SLOTS) of uint16, 0 is free; buckets a power of two

    @classmethod
    def for_keys(cls, n: int) -> CuckooFilter:
        buckets = 1 << max(int(np.ceil(np.log2(max(n, 1) / (SLOTS * 0.8)))), 3)
        return cls(np.zeros((buckets, SLOTS), np.uint16))

    def _places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        mask = np.uint64(len(self.table) - 1)
        mark = ((keys >> np.uint64(48)) % np.uint64(65535) + np.uint64(1)).astype(np.uint16)
        one = mix(keys ^ np.uint64(0xD6E8FEB86659FD93)) & mask  # a shard's keys are alike in their own bits
        return mark, one.astype(np.int64), self._other(one, mark)

    def _other(self, bucket: np.ndarray, mark: np.ndarray) -> np.ndarray:
        mask = np.uint64(len(self.table) - 1)
        return ((bucket.astype(np.uint64) ^ mix(mark.astype(np.uint64))) & mask).astype(np.int64)

    def tests(self, keys: np.ndarray) -> np.ndarray:
        mark, one, two = self._places(keys)
        return (self.table[one] == mark[:, None]).any(1) | (self.table[two] == mark[:, None]).any(1)

    def _settle(self, mark: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        """Puts marks into free slots of their buckets; True where that worked."""
        done = np.zeros(len(mark), bool)
        for _ in range(SLOTS):
            open_ = np.flatnonzero(~done)
            free = self.table[bucket[open_]] == 0
            able = free.any(1)
            open_, slot = open_[able], free[able].argmax(1)
            _, first = np.unique(bucket[open_], return_index=True)  # one per bucket at a time
            if not len(first):
                break
            self.table[bucket[open_[first]], slot[first]] = mark[open_[first]]
            done[open_[first]] = True
        return done

    def insert(self, keys: np.ndarray) -> bool:
        """False if the table is too full; then the filter is to be built anew, larger."""
        mark, one, two = self._places(keys)
        done = self._settle(mark, one)
        left = np.flatnonzero(~done)
        done[left] = self._settle(mark[left], two[left])
        left = np.flatnonzero(~done)
        mark, bucket = mark[left], two[left]
        dice = np.random.default_rng(len(self.table))
        for _ in range(KICKS):
            if not len(mark):
                return True
            _, first = np.unique(bucket, return_index=True)
            slot = dice.integers(SLOTS, size=len(first))
            out = self.table[bucket[first], slot]
            self.table[bucket[first], slot] = mark[first]
            mark[first] = out
            bucket[first] = self._other(bucket[first], out)
            mark_done = (mark == 0) | self._settle(mark, bucket)
            mark, bucket = mark[~mark_done], bucket[~mark_done]
        return not len(mark)

    def delete(self, keys: np.ndarray) -> None:
        mark, one, two = self._places(keys)
        for m, a, b in zip(mark, one, two, strict=True):
            for bucket in (a, b):
                hit = np.flatnonzero(self.table[bucket] == m)
                if len(hit):
                    self.table[bucket, hit[0]] = 0
                    break


def line_spans(s: Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and rows of all lines; an empty text has one."""
    newline = np.flatnonzero(s.data == 0x0A)
    row_end = s.offsets[1:]
    # a line ends at a newline or at the end of its text
    end = np.concatenate([newline, row_end])
    row = np.concatenate([np.searchsorted(s.offsets, newline, "right") - 1, np.arange(len(s))])
    order = np.lexsort((np.concatenate([np.zeros(len(newline)), np.ones(len(s))]), end, row))
    end, row = end[order], row[order]
    start = np.concatenate([[0], end[:-1] + 1])
    head = np.concatenate([[True], row[1:] != row[:-1]])
    start[head] = s.offsets[row[head]]
    return start, end, row


@dataclass
class Keys:
    """The lines of a slice that can be repeated: line number, row and 128-bit key."""

    line: np.ndarray
    row: np.ndarray
    high: np.ndarray
    low: np.ndarray


def line_keys(s: Slice, min_chars: int = MIN_CHARS) -> tuple[tuple, Keys]:
    start, end, row = line_spans(s)
    solid = np.flatnonzero(~_STRIP[s.data])
    a = np.searchsorted(solid, start)
    b = np.searchsorted(solid, end)
    some = b > a
    if len(solid):
        begin = np.where(some, solid[np.minimum(a, len(solid) - 1)], start)
        stop = np.where(some, solid[np.maximum(b, 1) - 1] + 1, start)
    else:
        begin = stop = start
    points = np.concatenate([[0], np.cumsum((s.data & 0xC0) != 0x80)])  # code points before a byte
    line = np.flatnonzero(points[stop] - points[begin] >= min_chars)
    data = s.lower().data
    high = hashes(data, begin[line], stop[line])
    low = hashes(data, begin[line], stop[line], seed=1)  # independent of the first half
    return (start, end, row), Keys(line, row[line], high, low)


REFERENCE = "high long, low long, doc_id long, n_lines long, version long"


def shard_of(shards: int) -> Column:
    """The shard of the key in ``high``."""
    return F.pmod(F.col("high"), F.lit(shards)).cast("int").alias("shard")


def references(docs: DataFrame, min_chars: int) -> DataFrame:
    """One row per key and document, as far as an Arrow batch shows them together."""

    def job(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        ids = batch.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64)
        version = take_column(batch, "version").to_numpy()
        for s in slices(batch.column("text")):
            _, keys = line_keys(s, min_chars)
            if not len(keys.line):
                continue
            order = np.lexsort((keys.low, keys.high, keys.row))
            row, high, low = keys.row[order], keys.high[order], keys.low[order]
            new = np.concatenate(
                [[True], (row[1:] != row[:-1]) | (high[1:] != high[:-1]) | (low[1:] != low[:-1])]
            )
            at = np.flatnonzero(new)
            yield batch_of(
                high=signed(high[at]),
                low=signed(low[at]),
                doc_id=ids[s.first + row[at]],
                n_lines=np.diff(np.append(at, len(row))),
                version=version[s.first + row[at]],
            )

    found = docs.filter("doc_id is not null").select("doc_id", "text", F.xxhash64("text").alias("version"))
    return arrow_map(found, job, REFERENCE)


def repeated(refs: DataFrame) -> DataFrame:
    """(high, low, keeper) of the keys that at least two documents hold.

    Minimum and maximum tell two holders from one, and both shrink before the shuffle.
    """
    return (
        refs.groupBy("high", "low")
        .agg(F.min("doc_id").alias("keeper"), F.max("doc_id").alias("last"))
        .filter("keeper < last")
        .drop("last")
    )


def drops(refs: DataFrame) -> DataFrame:
    """(doc_id, version, lost_keys): the keys that each text of a document loses.

    Keys that repeat are a table of their own, so that AQE can split the references of a hot
    key in the join; a text's keys are bounded by its lines, and equal rows have one set of them.
    """
    keepers, _ = stage(repeated(refs), "line-keepers")
    lost = refs.join(keepers, ["high", "low"]).filter("doc_id != keeper")
    return lost.groupBy("doc_id", "version").agg(F.collect_set(F.struct("high", "low")).alias("lost_keys"))


def _filters(keys: DataFrame, old: DataFrame | None) -> DataFrame:
    """Filters by shard from (shard, high, gone): new keys go in, keys without references out.

    A shard's filter takes 2 to 5 bytes per key, as its buckets are a power of two.
    """

    def job(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        table = rows.column("filter").drop_null()
        values = rows.filter(rows.column("high").is_valid())
        high = np.ascontiguousarray(values.column("high").to_numpy()).view(np.uint64)
        gone = values.column("gone").to_numpy()
        known = high[values.column("known").to_numpy()]
        if len(table):
            box = CuckooFilter(np.frombuffer(table[0].as_py(), np.uint16).reshape(-1, SLOTS).copy())
            box.delete(high[gone])
            fresh = high[~gone & ~values.column("known").to_numpy()]
            ok = (len(box.table) * SLOTS * 0.9 > len(known) + len(fresh)) and box.insert(fresh)
        else:
            ok = False
        if not ok:
            everything = high[~gone]
            box = CuckooFilter.for_keys(len(everything))
            while not box.insert(everything):
                box = CuckooFilter(np.zeros((len(box.table) * 2, SLOTS), np.uint16))
        return pa.table(
            {"shard": pa.array([key[0].as_py()], pa.int32()), "filter": pa.array([box.table.tobytes()], pa.binary())}
        )

    rows = keys.select("shard", "high", "gone", "known", F.lit(None).cast("binary").alias("filter"))
    if old is not None:
        rows = rows.unionByName(
            old.select(
                "shard", F.lit(None).cast("long").alias("high"), F.lit(False).alias("gone"),
                F.lit(False).alias("known"), "filter",
            )
        )
    return rows.groupBy("shard").applyInArrow(job, "shard int, filter binary")


def _first_pass(refs: DataFrame, shards: int) -> DataFrame:
    """(shard, high, twice): each key once per Arrow batch, and whether two documents of it hold the key."""

    def job(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        high, ids = take_column(batch, "high").to_numpy(), take_column(batch, "doc_id").to_numpy()
        if not len(high):
            return
        order = np.lexsort((ids, high))
        high, ids = high[order], ids[order]
        at = np.flatnonzero(np.concatenate([[True], high[1:] != high[:-1]]))
        last = np.append(at[1:], len(high)) - 1
        yield batch_of(high=high[at], twice=ids[at] != ids[last])

    once = refs.select("high", "doc_id").mapInArrow(lambda batches: (out for b in batches for out in job(b)), "high long, twice boolean")
    return once.select(shard_of(shards), "high", "twice")


def _known_before(rows: DataFrame) -> DataFrame:
    """(shard, filter, high) from the rows of ``_first_pass``: the filter of each shard, and its keys that may repeat."""

    def job(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        high = np.ascontiguousarray(table.column("high").to_numpy()).view(np.uint64)
        twice = table.column("twice").to_numpy()
        found = [high[twice]]
        box = CuckooFilter.for_keys(len(high))
        at = 0
        while at < len(high):
            some, count = np.unique(high[at : at + CHUNK], return_counts=True)
            known = box.tests(some)
            found.append(some[known | (count > 1)])
            if not box.insert(some[~known]):  # crowded: all over again in a larger one
                box, at, found = CuckooFilter(np.zeros((len(box.table) * 2, SLOTS), np.uint16)), 0, [high[twice]]
                continue
            at += CHUNK
        again = signed(np.unique(np.concatenate(found)))
        shard = pa.array([key[0].as_py()] * (len(again) + 1), pa.int32())
        boxes = pa.array([box.table.tobytes()] + [None] * len(again), pa.binary())
        return pa.table({"shard": shard, "filter": boxes, "high": pa.array([None, *again.tolist()], pa.int64())})

    return rows.groupBy("shard").applyInArrow(job, "shard int, filter binary, high long")


@dataclass
class LineIndex:
    """Reference table and filters of all documents inserted so far."""

    spark: SparkSession
    references: DataFrame
    filters: DataFrame
    shards: int
    min_chars: int = MIN_CHARS
    perhaps: DataFrame | None = None  # (high) of the keys that may repeat, where the filters told

    @classmethod
    def of(cls, docs: DataFrame, shards: int | None = None, min_chars: int = MIN_CHARS) -> LineIndex:
        """The index of a first set of documents."""
        raw, _ = stage(references(docs, min_chars), "line-refs")
        shards = shards or max(1, -(-raw.count() // SHARD_KEYS))
        seen, _ = stage(_known_before(_first_pass(raw, shards)), "line-filters")
        filters = seen.filter("filter is not null").select("shard", "filter")
        perhaps = seen.filter("high is not null").select("high")
        return cls(docs.sparkSession, raw, filters, shards, min_chars, perhaps)

    def perhaps_known(self, refs: DataFrame) -> DataFrame:
        """The references whose keys the filters can't rule out."""
        return refs.join(self._hits(refs), "high", "left_semi").select(*refs.columns)

    def _hits(self, refs: DataFrame) -> DataFrame:
        """(high) of their keys."""

        def job(key: tuple[pa.Scalar, ...], new: pa.Table, filters: pa.Table) -> pa.Table:
            if not filters.num_rows or not new.num_rows:
                return new.select(["high"]).slice(0, 0)
            box = CuckooFilter(np.frombuffer(filters.column("filter")[0].as_py(), np.uint16).reshape(-1, SLOTS))
            high = np.ascontiguousarray(new.column("high").to_numpy()).view(np.uint64)
            return new.select(["high"]).filter(pa.array(box.tests(high)))

        # each key once per batch of references: however many documents hold it, a shard sees little of it
        keys = _first_pass(refs, self.shards).select("shard", "high")
        return keys.groupBy("shard").cogroup(self.filters.groupBy("shard")).applyInArrow(job, "high long").distinct()

    def insert(self, docs: DataFrame) -> tuple[LineIndex, DataFrame]:
        """The index with more documents, and the keys they share with those already there."""
        new, _ = stage(references(docs, self.min_chars), "line-refs")
        hits, _ = stage(self._hits(new), "line-hits")
        held = self.references.join(hits, "high", "left_semi").select("high", "low").distinct()
        shared, _ = stage(new.join(held, ["high", "low"], "left_semi").select("high", "low").distinct(), "line-shared")
        both, _ = stage(self.references.unionByName(new), "line-refs")
        return self._after(both, new, False), shared

    def delete(self, doc_ids: DataFrame) -> LineIndex:
        """The index without the documents of the rows (doc_id)."""
        ids = doc_ids.select("doc_id").distinct()
        rest, _ = stage(self.references.join(ids, "doc_id", "left_anti").select(*self.references.columns), "line-refs")
        gone = self.references.join(ids, "doc_id", "left_semi").select(*self.references.columns)
        return self._after(rest, gone, True)

    def _after(self, refs: DataFrame, changed: DataFrame, removal: bool) -> LineIndex:
        was = self.references.select(shard_of(self.shards), "high").distinct().withColumn("was", F.lit(True))
        now = refs.select(shard_of(self.shards), "high").distinct().withColumn("now", F.lit(True))
        keys = was.join(now, ["shard", "high"], "full").select(
            "shard", "high", F.col("now").isNull().alias("gone"),
            (F.col("was").isNotNull() & F.col("now").isNotNull()).alias("known"),
        )
        filters, _ = stage(_filters(keys, self.filters), "line-filters")
        return LineIndex(self.spark, refs, filters, self.shards, self.min_chars)

    def resolve(self, docs: DataFrame) -> DataFrame:
        """docs with the text that stays, and line_count, lines_dropped."""
        refs = self.references
        if self.perhaps is not None:
            refs = refs.join(self.perhaps, "high", "left_semi")
        return without_lines(docs, drops(refs), self.min_chars)


def without_lines(docs: DataFrame, lost: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """Joins the documents with their lost keys and cuts those lines out of the text."""
    docs = docs.drop("line_count", "lines_dropped")
    columns = docs.columns
    lost = lost.select(
        F.col("doc_id").alias("_encore_id"), F.col("version").alias("_encore_version"), F.col("lost_keys").alias("_encore_lost")
    )
    same = (F.col("doc_id") == F.col("_encore_id")) & (F.xxhash64("text") == F.col("_encore_version"))
    both = docs.join(lost, same, "left").drop("_encore_id", "_encore_version")

    def job(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        texts = batch.column("text")
        lists = batch.column("_encore_lost")
        high = np.ascontiguousarray(lists.flatten().field("high").to_numpy()).view(np.uint64)
        low = np.ascontiguousarray(lists.flatten().field("low").to_numpy()).view(np.uint64)
        size = lists.value_lengths().fill_null(0).to_numpy()
        first = np.concatenate([[0], np.cumsum(size)])
        out, count, dropped = [], [], []
        for s in slices(texts):
            (start, end, row), keys = line_keys(s, min_chars)
            lines = np.searchsorted(row, np.arange(len(s) + 1))
            held = np.searchsorted(keys.row, np.arange(len(s) + 1))
            for r in range(len(s)):
                a, b = first[s.first + r], first[s.first + r + 1]
                n = int(lines[r + 1] - lines[r])
                at = slice(held[r], held[r + 1])
                go = np.isin(keys.high[at], high[a:b])
                if go.any():  # both halves of a key have to agree
                    pairs = set(zip(high[a:b].tolist(), low[a:b].tolist(), strict=True))
                    go = np.array([p in pairs for p in zip(keys.high[at].tolist(), keys.low[at].tolist(), strict=True)])
                count.append(n)
                dropped.append(int(go.sum()))
                if not go.any():
                    out.append(texts[s.first + r].as_py())
                    continue
                stay = np.ones(n, bool)
                stay[keys.line[at][go] - lines[r]] = False
                at = lines[r] + np.flatnonzero(stay)
                kept = [s.data[i:j].tobytes() for i, j in zip(start[at], end[at], strict=True)]
                out.append(b"\n".join(kept).decode())
        got = dict(zip(batch.schema.names, batch.columns, strict=True))
        got["text"] = pa.array(out, pa.string())
        got = {c: got[c] for c in columns}
        yield batch_of(**got, line_count=pa.array(count, pa.int64()), lines_dropped=pa.array(dropped, pa.int64()))

    return arrow_map(both, job, f"{ddl(docs)}, line_count long, lines_dropped long")


def dedup_lines(docs: DataFrame, shards: int | None = None, min_chars: int = MIN_CHARS) -> DataFrame:
    """All columns of docs, the text without its repeated lines, line_count, lines_dropped."""
    return LineIndex.of(docs, shards, min_chars).resolve(docs)

