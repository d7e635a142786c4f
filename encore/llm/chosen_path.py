"""Near-duplicate documents by a chosen-path similarity join on 5-word shingles.

Two documents link when 100 * |A & B| >= 85 * |A | B|. Documents with equal sets of shingles are
one node, so copies, however many, take part once. Each node has a signature of ``WIDTH`` minwise
values; two sets agree in a place with a probability equal to their similarity.

1. *Branching.* In each of ``TREES`` trees all nodes begin at the root. A tree node (a path)
   chooses one place of the signature, and a second one with probability 1 / 0.85 - 1, by a
   hash of the path; each document goes on to the child named by its value there. Linked
   documents thus have one common child or more on average at every depth, others fewer.
   Children of one document end there.
2. *Small tree nodes* of at most ``SMALL`` documents are compared exhaustively, pair by pair, by
   signature. The same documents in several trees are one tree node.
3. *Large tree nodes* first compare all their documents with the smallest of them. If what is
   known then connects all, nothing is left to find there; else all of them branch again, the
   further at once the larger the node is, a level for each halving it needs.
   What is still large at depth ``DEEP`` is taken for connected and left to step 4.
4. *Confirmation.* What may link makes groups, in which links are verified on whole sets
   (``verify.py``): no pair is linked by its signature.

A link of similarity 0.85 survives a tree to depth 1, 2, 3, 4 with probability 0.87, 0.78, 0.70 and
0.64, so six trees miss it at depth 4 once in 450 times, and at depth 1 once in 240,000; the tests
measure recall. The signatures of a linked pair fall below the mark of step 2 once in 50,000.

Defined results: a null or empty text has no shingles and is its own component; a text of fewer
than five words is one shingle; a row with a null doc_id has a null component and is kept; rows
that share a doc_id are looked at by their own texts. Empty tables give empty results. Other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from encore.llm.common import arrow_map, batch_of, packed, take_column
from encore.llm.components import components, join_groups
from encore.llm.membership import Filter
from encore.llm.textarrays import mix
from encore.llm.verify import arrays, by_key, fingerprint, shingle_sets, spread, verify_groups
from encore.scratch import stage

PERCENT = 85
WIDTH = 64  # minwise values of a signature
TREES = 6
SMALL = 4096
DEEP = 24
#: Places in which two signatures must agree: four standard deviations below 85 %.
ALIKE = int(WIDTH * 0.85 - 4 * (WIDTH * 0.85 * 0.15) ** 0.5)
STEP = 1 << 20  # values hashed at a time, but for a longer set

_TIMES = mix(np.arange(1, WIDTH + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
_PLUS = mix(_TIMES)


def signatures(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Minwise values of sets, given back to back: sets by WIDTH, 32 bits each. No set is empty."""
    out = np.empty((len(first) - 1, WIDTH), np.uint32)
    for k in range(WIDTH):
        hashed = ((values * _TIMES[k] + _PLUS[k]) >> np.uint64(32)).astype(np.uint32)
        out[:, k] = np.minimum.reduceat(hashed, first[:-1])
    return out


def _profiles(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    n = np.zeros(batch.num_rows, np.int64)
    node, guard = n.copy(), n.copy()
    found = [b""] * len(n)
    held: list[tuple[int, np.ndarray]] = []
    size = 0

    def sign() -> None:
        sizes = [len(v) for _, v in held]
        rows = signatures(np.concatenate([v for _, v in held]), np.concatenate([[0], np.cumsum(sizes)]))
        for (r, _), row in zip(held, rows, strict=True):
            found[r] = row.tobytes()
        held.clear()

    for r, values in shingle_sets(batch):
        n[r] = len(values)
        node[r], guard[r] = fingerprint(values)
        if held and size + len(values) > STEP:
            sign()
            size = 0
        held.append((r, values))
        size += len(values)
    if held:
        sign()
    yield batch_of(
        doc_id=take_column(batch, "doc_id"), n=n, node=pa.array(node, mask=n == 0), guard=guard, signature=pa.array(found, pa.binary())
    )


def _matrix(column: pa.Array) -> np.ndarray:
    return np.array([np.frombuffer(v, np.uint32) for v in column.to_pylist()], np.uint32).reshape(-1, WIDTH)


def _bytes(column: pa.Array) -> np.ndarray:
    """Signatures to be compared: the lowest byte of each value."""
    return _matrix(column).astype(np.uint8)


def chosen_places(path: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The place that each path chooses, and the second one or -1."""
    dice = mix(path + np.uint64(0x2545F4914F6CDD1D))
    one = (dice % np.uint64(WIDTH)).astype(np.int64)
    two = (one + 1 + (mix(dice) % np.uint64(WIDTH - 1)).astype(np.int64)) % WIDTH
    odds = (mix(dice + np.uint64(1)) >> np.uint64(11)).astype(np.float64) / 2.0**53
    return one, np.where(odds < 100 / PERCENT - 1, two, -1)


def _child(path: np.ndarray, place: np.ndarray, values: np.ndarray) -> np.ndarray:
    """The child of each path for the values in a chosen place."""
    named = values.astype(np.uint64) | (place.astype(np.uint64) << np.uint64(32))
    return np.ascontiguousarray(mix(mix(path) ^ mix(named))).view(np.int64)


def _children(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """(path, node, n) of the descendants after ``levels``, from (path, node, n, levels, signature)."""
    if not batch.num_rows:
        return
    path = take_column(batch, "path").to_numpy().view(np.uint64)
    node, n, levels = (take_column(batch, c).to_numpy() for c in ("node", "n", "levels"))
    values = _matrix(take_column(batch, "signature"))
    at = np.arange(len(path))
    while len(at):
        grown = []
        for place in chosen_places(path):
            on = np.flatnonzero(place >= 0)
            grown.append((_child(path[on], place[on], values[at[on], place[on]]), at[on]))
        path, at = (np.concatenate(parts) for parts in zip(*grown, strict=True))
        levels = levels - 1
        there = levels[at] == 0
        yield batch_of(path=path[there], node=node[at[there]], n=n[at[there]])
        path, at = path[~there].view(np.uint64), at[~there]


def _from_roots(trees: int):
    """Job: the children of the roots of all trees."""
    roots = mix(np.arange(1, trees + 1, dtype=np.uint64))

    def job(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        if not batch.num_rows:
            return
        values = _matrix(take_column(batch, "signature"))
        for root, *places in zip(roots, *chosen_places(roots), strict=True):
            for place in places:
                if place >= 0:
                    path, at = np.full(len(values), root), np.full(len(values), place)
                    yield batch_of(
                        path=_child(path, at, values[:, place]), node=take_column(batch, "node"), n=take_column(batch, "n")
                    )

    return job


PATHS = "path long, node long, n long"


def _sizes(paths: DataFrame) -> DataFrame:
    """(path, members, name): ``name`` tells sets of documents apart."""
    name = F.bit_xor(F.xxhash64("node"))
    return paths.groupBy("path").agg(F.count("*").alias("members"), name.alias("name")).filter("members > 1")


def _like(a: np.ndarray, b: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Pairs of signatures, one byte a place, of sets of sizes n and m, that may belong to linked sets."""
    sized = 100 * np.minimum(n, m) >= PERCENT * np.maximum(n, m)
    return sized & ((a == b).sum(-1, dtype=np.int16) >= ALIKE)


def _exhaustive(table: pa.Table) -> Iterator[pa.RecordBatch]:
    """(a, b) from whole tree nodes (tile, node, n, signature): as many as connect what may link."""
    tile, node, n = (table.column(c).to_numpy() for c in ("tile", "node", "n"))
    order = np.lexsort((n, tile))
    tile, node, n = tile[order], node[order], n[order]
    values = _bytes(table.column("signature").combine_chunks())[order]
    group = np.arange(len(tile))
    rows, step = np.arange(len(tile)), 1
    while len(rows):
        rows = rows[rows + step < len(tile)]
        rows = rows[(tile[rows] == tile[rows + step]) & (100 * n[rows] >= PERCENT * n[rows + step])]
        apart = rows[group[rows] != group[rows + step]]
        for part in np.array_split(apart, len(apart) * WIDTH // (1 << 22) + 1):
            other = part + step
            good = _like(values[part], values[other], n[part], n[other])
            if good.any():
                yield batch_of(a=node[part[good]], b=node[other[good]])
                join_groups(group, part[good], other[good])
        step += 1


def _star(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """(a, b) of the documents of a large tree node that are like its smallest."""
    if batch.num_rows:
        node, pivot = take_column(batch, "node").to_numpy(), take_column(batch, "pivot").to_numpy()
        n, m = take_column(batch, "n").to_numpy(), take_column(batch, "pivot_n").to_numpy()
        good = _like(_bytes(take_column(batch, "signature")), _bytes(take_column(batch, "pivot_signature")), n, m)
        good &= node != pivot
        yield batch_of(a=pivot[good], b=node[good])


LINKS = "a long, b long"


def _mixed(large: DataFrame, links: DataFrame) -> DataFrame:
    """The rows of large tree nodes whose documents ``links`` do not connect, and how many ``levels`` they go on at once."""
    parts = components(links).select("node", F.col("component").alias("part"))
    now = large.join(parts, "node", "left").withColumn("part", F.coalesce("part", "node"))
    levels = F.greatest(F.ceil(F.log2(F.count("*") / SMALL)), F.lit(1)).cast("int").alias("levels")
    open_ = now.groupBy("path").agg(F.min("part").alias("low"), F.max("part").alias("high"), levels).filter("low < high")
    return large.join(open_.select("path", "levels"), "path")


def _union(parts: list[DataFrame]) -> DataFrame:
    found = parts[0]
    for more in parts[1:]:
        found = found.unionByName(more)
    return found


def candidate_links(nodes: DataFrame, trees: int = TREES) -> DataFrame:
    """(a, b): as many pairs as connect all documents (node, n, signature) that the trees find alike."""
    links: list[DataFrame] = []
    tiles: list[DataFrame] = []
    children = arrow_map(nodes.select("node", "n", "signature"), _from_roots(trees), PATHS)
    depth = 1
    while True:
        paths, _ = stage(children, "paths")
        sizes, _ = stage(_sizes(paths), "tree-nodes")
        few = sizes.filter(F.col("members") <= SMALL)
        # the same documents are looked at once, by one of their paths
        few = few.groupBy("name", "members").agg(F.min("path").alias("path")).select("path")
        small, _ = stage(paths.join(few, "path", "left_semi").select(F.col("path").alias("tile"), "node"), "small-nodes")
        tiles.append(small)
        many = sizes.filter(F.col("members") > SMALL).select("path")
        if many.isEmpty():
            break
        large, _ = stage(paths.join(many, "path", "left_semi").join(nodes.select("node", "signature"), "node"), "large-nodes")
        first = large.groupBy("path").agg(F.min(F.struct("node", "n", "signature")).alias("first"))
        first = first.select(
            "path", F.col("first.node").alias("pivot"), F.col("first.n").alias("pivot_n"), F.col("first.signature").alias("pivot_signature")
        )
        if depth >= DEEP:
            star = large.join(first, "path").filter("node != pivot").select(F.col("pivot").alias("a"), F.col("node").alias("b"))
        else:
            star = arrow_map(large.join(first, "path"), _star, LINKS)
        found, _ = stage(star.distinct(), "star-links")
        links.append(found)
        active, _ = stage(_mixed(large, _union(links)), "open-nodes")
        further = active.agg(F.max("levels")).first()[0]
        if further is None or depth >= DEEP:
            break
        depth += further
        children = arrow_map(active.select("path", "node", "n", "levels", "signature"), _children, PATHS)
    compared = _union(tiles).join(nodes, "node")
    size = _union(tiles).count() * (4 * WIDTH + 24)
    small = spread(compared.select("tile", "node", "n", "signature"), "tile", size).mapInArrow(by_key("tile", _exhaustive), LINKS)
    found, _ = stage(small, "candidates", gathered=True)
    return _union([*links, found])


def _guarded(rep: str) -> Column:
    stop = F.raise_error(F.lit("two sets share a fingerprint")).cast("long")
    return F.when(F.col("low") == F.col("high"), F.col(rep)).otherwise(stop)


def near_duplicates(docs: DataFrame, trees: int = TREES) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row per document."""
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    profiles, _ = stage(arrow_map(text, _profiles, "doc_id long, n long, node long, guard long, signature binary"), "profiles")
    known = profiles.filter("n > 0 and doc_id is not null")
    nodes, _ = stage(
        known.groupBy("node", "n")
        .agg(F.min("doc_id").alias("rep"), F.min("guard").alias("low"), F.max("guard").alias("high"), F.max("signature").alias("signature"))
        .withColumn("rep", _guarded("rep"))
        .drop("low", "high"),
        "nodes",
    )
    found = candidate_links(nodes.select("node", "n", "signature"), trees)
    groups, _ = stage(components(found).select(F.col("component").alias("tile"), "node"), "groups")
    seen = text.filter("doc_id is not null").select("text")
    sets, _ = stage(arrays(seen, Filter.of(groups.select("node"))), "arrays")
    links = verify_groups(groups, groups, sets, found.limit(0), PERCENT)
    parts = components(links).join(nodes.select("node", "rep"), "node")
    least = parts.groupBy("component").agg(F.min("rep").alias("least"))
    least = parts.join(least, "component").select("node", "least")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("least", "rep", "doc_id"))
    return (
        profiles.select("doc_id", "n", "node")
        .join(nodes.select("node", "rep"), "node", "left")
        .join(least, "node", "left")
        .select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )
