"""Exact links among sets that may be alike, found by comparing whole sorted arrays.

Two sets link when 100 * |A & B| >= percent * |A | B|. Sets that some search holds for alike
come as groups; out go as many links as connect what is linked, never all pairs of a group.

Each set's array goes to its group once. Pairs that are not connected yet are compared by bitmaps
with a bit for each hash, set by the parity of the elements that fall on it: the number of
differing bits is at most the size of the symmetric difference, so it bounds the overlap from
above. What is left is verified by intersecting the sorted arrays, and only links that connect
are emitted. A group is cut into blocks of ``BLOCK`` sets and ``BLOCK_BYTES`` of arrays: first each
set is compared in its block and with a set that all blocks have, then only blocks that still hold
different components are compared with each other.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.llm.common import arrow_map, batch_of, flat, packed, take_column
from encore.llm.components import components, join_groups
from encore.llm.membership import Filter
from encore.llm.textarrays import distinct, mix, shingles, signed, slices, words
from encore.scratch import stage

BLOCK = 1024  # sets
BLOCK_BYTES = 32 << 20  # of arrays
TASK_BYTES = 32 << 20


def least_overlap(total: np.ndarray | int, percent: int):
    """The least intersection of two linked sets with ``total`` elements together."""
    return -(-percent * total // (100 + percent))


def bits_of(n: int) -> int:
    return max(64, 1 << int(n - 1).bit_length()) if n > 1 else 64


def bitmap(values: np.ndarray) -> np.ndarray:
    """Parity of the elements on each bit, as 64-bit words; halves fold onto each other by xor."""
    bits = bits_of(len(values))
    odd = np.bincount((values >> np.uint64(8)).astype(np.int64) & (bits - 1), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.uint64)


def fingerprint(values: np.ndarray) -> tuple[int, int]:
    """The name of a set and a guard: a second, independent one."""
    one = mix(values ^ np.uint64(0x5851F42D4C957F2D))
    two = mix(values ^ np.uint64(0x14057B7EF767814F))
    n = np.uint64(len(values))
    ends = mix(np.array([one.sum() + n, two.sum() ^ np.bitwise_xor.reduce(one)], np.uint64))
    return int(ends[0].view(np.int64)), int(ends[1].view(np.int64))


def shingle_sets(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
    """Row and sorted distinct shingles of each text that has words."""
    for s in slices(take_column(batch, "text")):
        values, first = shingles(words(s.lower()))
        for r in range(len(s)):
            if first[r + 1] > first[r]:
                yield s.first + r, distinct(values[first[r] : first[r + 1]])


def spread(df: DataFrame, key: str, size: int) -> DataFrame:
    """Rows of a key one after the other, in partitions of about TASK_BYTES of ``size`` bytes."""
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(least, -(-size // TASK_BYTES)), key).sortWithinPartitions(key)


def by_key(key: str, job: Callable[[pa.Table], Iterator[pa.RecordBatch]]) -> Callable:
    """Runs ``job`` on the rows of some whole keys at a time, of a partition sorted by ``key``.

    A task holds one Arrow batch and the rows of one key.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = take_column(batch, key).to_numpy()
            change = np.flatnonzero(keys[1:] != keys[:-1]) + 1
            if held and take_column(held[-1], key)[-1].as_py() != keys[0]:
                change = np.concatenate([[0], change])
            if not len(change):
                held.append(batch)
                continue
            done = [*held, batch.slice(0, int(change[-1]))]
            yield from job(pa.Table.from_batches([b for b in done if b.num_rows]).combine_chunks())
            held = [batch.slice(int(change[-1]))]
        if held:
            yield from job(pa.Table.from_batches(held).combine_chunks())

    return run


def _reach(n: np.ndarray, tile: np.ndarray, step: int, rows: np.ndarray, percent: int) -> np.ndarray:
    """Those rows that are in one tile with the row ``step`` further on and may link by size."""
    rows = rows[rows + step < len(n)]
    other = rows + step
    return rows[(tile[rows] == tile[other]) & (100 * n[rows] >= percent * n[other])]


def close_pairs(
    tile: np.ndarray, n: np.ndarray, group: np.ndarray, values: np.ndarray, first: np.ndarray, width: np.ndarray, percent: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of pairs of one tile and two groups that by their bitmaps may link, nearest sizes first.

    Rows are sorted by tile and size. The bitmap of a row is ``values`` from ``first`` on,
    ``width`` words. Groups may be joined between one batch of pairs and the next.
    """
    for w in distinct(width):
        level = np.flatnonzero((width == w) | (width == 2 * w))
        maps = np.empty((len(level), w), np.uint64)
        plain = width[level] == w
        maps[plain] = values[first[level[plain]][:, None] + np.arange(w)]
        wide = first[level[~plain]][:, None] + np.arange(w)
        maps[~plain] = values[wide] ^ values[wide + w]
        sizes, tiles = n[level], tile[level]
        rows, step = np.flatnonzero(plain), 1
        while len(rows):
            rows = _reach(sizes, tiles, step, rows, percent)
            apart = rows[group[level[rows]] != group[level[rows + step]]]
            for part in np.array_split(apart, len(apart) * int(w) // (1 << 20) + 1):
                other = part + step
                differ = np.bitwise_count(maps[part] ^ maps[other]).sum(1, dtype=np.int64)
                total = sizes[part] + sizes[other]
                good = differ <= total - 2 * least_overlap(total, percent)
                if good.any():
                    yield level[part[good]], level[other[good]]
            step += 1


def possible_links(percent: int) -> Callable:
    """Job on rows (tile, node, n, bitmap) sorted by tile: (a, b) of pairs that by their bitmaps may link.

    As many as connect the nodes of a tile.
    """

    def job(table: pa.Table) -> Iterator[pa.RecordBatch]:
        tile, node, n = (table.column(c).to_numpy() for c in ("tile", "node", "n"))
        order = np.lexsort((n, tile))
        tile, node, n = tile[order], node[order], n[order]
        values, first = flat(table.column("bitmap").combine_chunks())
        first, width = first[:-1][order], np.diff(first)[order]
        group = np.arange(len(tile))
        for one, two in close_pairs(tile, n, group, values, first, width, percent):
            new = group[one] != group[two]
            join_groups(group, one, two)
            yield batch_of(a=node[one[new]], b=node[two[new]])

    return by_key("tile", job)


ARRAYS = "node long, n long, values binary"


def arrays(docs: DataFrame, wanted: Filter) -> DataFrame:
    """(node, n, values) of the sets that pass the filter, once per Arrow batch."""

    def job(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        seen: dict[int, np.ndarray] = {}
        for _, values in shingle_sets(batch):
            node, _ = fingerprint(values)
            if node not in seen and wanted.has(np.array([node], np.int64))[0]:
                seen[node] = values
        yield batch_of(
            node=pa.array(list(seen), pa.int64()), n=pa.array([len(v) for v in seen.values()], pa.int64()),
            values=packed(list(seen.values())),
        )

    return arrow_map(docs.select("text"), job, ARRAYS)


def _links(percent: int) -> Callable:
    """Job on rows (tile, node, n, part, values) sorted by tile: (a, b) of links that join parts."""

    def job(table: pa.Table) -> Iterator[pa.RecordBatch]:
        tile, node, n, part = (table.column(c).to_numpy() for c in ("tile", "node", "n", "part"))
        order = np.lexsort((node, n, tile))
        new = np.ones(len(order), bool)
        new[1:] = (tile[order][1:] != tile[order][:-1]) | (node[order][1:] != node[order][:-1])
        order = order[new]
        tile, node, n, part = tile[order], node[order], n[order], part[order]
        values, first = flat(table.column("values").combine_chunks())
        sets = [values[first[r] : first[r + 1]] for r in order]
        maps = [bitmap(s) for s in sets]
        width = np.array([len(m) for m in maps], np.int64)
        starts = np.searchsorted(tile, tile, "left")
        stops = np.searchsorted(tile, tile, "right")
        group = np.unique(mix(signed(tile).view(np.uint64)) ^ signed(part).view(np.uint64), return_inverse=True)[1]
        found: list[tuple[int, int]] = []
        for one, two in close_pairs(tile, n, group, np.concatenate(maps), np.cumsum(width) - width, width, percent):
            for i, j in zip(one.tolist(), two.tolist(), strict=True):
                if group[i] == group[j]:
                    continue
                if len(np.intersect1d(sets[i], sets[j], assume_unique=True)) >= least_overlap(int(n[i] + n[j]), percent):
                    found.append((int(node[i]), int(node[j])))
                    own = group[starts[i] : stops[i]]
                    own[own == group[j]] = group[i]
        if found:
            one, two = zip(*found, strict=True)
            yield batch_of(a=pa.array(one, pa.int64()), b=pa.array(two, pa.int64()))

    return by_key("tile", job)


def _verified(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links among the rows (tile, node, part); only the arrays they need are shuffled."""
    wanted = Filter.of(members.select("node"))

    def job(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        yield batch.filter(pa.array(wanted.has(take_column(batch, "node").to_numpy())))

    size = members.join(sets.select("node", "n"), "node").agg(F.sum(F.col("n") * 8)).first()[0] or 0
    members = members.join(arrow_map(sets, job, ARRAYS), "node")
    return spread(members.select("tile", "node", "n", "part", "values"), "tile", int(size)).mapInArrow(
        _links(percent), "a long, b long"
    )


def verify_groups(own: DataFrame, every: DataFrame, sets: DataFrame, links: DataFrame, percent: int) -> DataFrame:
    """``links`` and those found among nodes of a group, as far as they connect.

    ``own`` (tile, node) has each node in one group, ``every`` in all of its groups, and
    ``sets`` the arrays (node, n, values) of all these nodes.
    """
    salt = F.pmod(F.xxhash64("node", F.lit(11)), F.lit(1 << 30))
    known = sets.select("node", "n").distinct()
    weighed = own.join(known, "node")
    sizes = weighed.groupBy("tile").agg(F.count("*").alias("members"), F.min("node").alias("pivot"), F.sum("n").alias("elements"))
    blocks = F.ceil(F.greatest(F.col("members") / BLOCK, F.col("elements") * 8 / BLOCK_BYTES))
    # read by several jobs below, each of which would plan and make them again
    sizes, _ = stage(sizes.withColumn("blocks", blocks).drop("elements"), "group-sizes", gathered=True)
    placed = own.join(sizes, "tile").select("tile", "node", F.pmod(salt, F.col("blocks")).alias("block"))
    pivots = sizes.filter("blocks > 1").select(
        "tile", F.col("pivot").alias("node"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block")
    )
    first = placed.unionByName(pivots)
    first, _ = stage(first.select(F.xxhash64("tile", "block").alias("tile"), "node", F.col("node").alias("part")), "first-blocks")
    found, _ = stage(_verified(first, sets, percent), "links", gathered=True)
    links = links.unionByName(found)

    # all pairs of groups of one block are done; others are looked at by component
    done = sizes.filter("blocks = 1").join(every.groupBy("tile").count(), "tile").filter("members = count").select("tile")
    open_, _ = stage(every.join(done, "tile", "left_anti").select("tile", "node"), "open-groups")
    if open_.isEmpty():
        return links
    parts = components(links).withColumnRenamed("component", "part")
    now, _ = stage(
        open_.join(parts, "node", "left").withColumn("part", F.coalesce("part", "node")).join(known, "node"),
        "group-parts",
    )
    tiles = (
        now.groupBy("tile", "part")
        .agg(F.count("*").alias("members"), F.sum("n").alias("elements"))
        .groupBy("tile")
        .agg(
            F.sum("members").alias("all"), F.max("members").alias("major"), F.count("*").alias("parts"),
            F.max_by("part", F.struct("members", "part")).alias("major_part"),
            F.max_by("elements", F.struct("members", "part")).alias("major_elements"), F.sum("elements").alias("elements"),
        )
        .filter("parts > 1")
        .withColumn("m", F.ceil(F.greatest(F.col("major") / BLOCK, F.col("major_elements") * 8 / BLOCK_BYTES)))
        .withColumn("r", F.ceil(F.greatest((F.col("all") - F.col("major")) / BLOCK, (F.col("elements") - F.col("major_elements")) * 8 / BLOCK_BYTES)))
    )
    placed = now.join(tiles.drop("elements"), "tile").withColumn("is_major", F.col("part") == F.col("major_part"))
    number = F.when(F.col("is_major"), F.pmod(salt, F.col("m"))).otherwise(F.col("m") + F.pmod(salt, F.col("r")))
    rest = F.sequence(F.col("m"), F.col("m") + F.col("r") - 1)
    all_blocks = F.sequence(F.lit(0).cast("long"), F.col("m") + F.col("r") - 1)
    paired = (
        placed.withColumn("block", number)
        .withColumn("other", F.explode(F.when(F.col("is_major"), rest).otherwise(all_blocks)))
        .select(F.xxhash64("tile", F.least("block", "other"), F.greatest("block", "other")).alias("tile"), "node", "part")
    )
    paired, _ = stage(paired, "group-blocks")
    found, _ = stage(_verified(paired, sets, percent), "links", gathered=True)
    return links.unionByName(found)
