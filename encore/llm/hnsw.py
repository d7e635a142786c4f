"""Approximate nearest neighbours: one small-world graph per shard, results merged.

Nearness is the inner product. Equal vectors are one node that lists the smallest ids of its
rows, as many as a result can need, so a vector that a third of the rows share costs one
node. Nodes are dealt to shards by hash: ``SHARDS`` of them, more where a shard would exceed
``SHARD_NODES``, which bounds a task's memory and keeps recall; the tests measure it for
independent vectors in a shard of that size. A shard's vectors are alike in length, within a
factor of 2 ** ``BAND``, and scaled together before they become single precision.

A shard's graph is a hierarchical navigable small world in flat arrays. Nodes are numbered
by falling level, so layer l is a matrix of the neighbour numbers of nodes 0 to n_l - 1.
Largest inner product becomes nearest neighbour by one more component that brings all
vectors of a shard to the same length. Nodes enter in batches: a beam search through the
layers finds candidates, nodes of the same batch are candidates too, and a candidate becomes
a neighbour unless one already chosen is nearer to it than the new node is. All searches of
a batch step together, as numpy operations.

Searching sends each distinct query vector to every shard, in parts of ``QUERIES_PER_TASK``.
A task reads a shard's graph, then streams its queries. Found nodes that may be among the best
are scored again in double precision on the original vectors, and the shards' lists are merged
by (score, smaller id).

Defined results: a vector that is null, empty, all zero or holds null, NaN or infinite
components takes no part, neither as query nor as candidate; nor does a row without id.
Vectors of different lengths are not candidates for each other. Rows that repeat an id and
vector are one candidate. A query has as many results as there are candidates, k at most.
Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from encore.llm.common import batch_of, packed, take_column
from encore.llm.textarrays import mix
from encore.scratch import stage

NEIGHBOURS = 16  # in upper layers; twice as many in the lowest
BEAM_BUILD = 80
BEAM_SEARCH = 320
SHARDS = 12
SHARD_NODES = 6_000  # most nodes of a shard, about; the tests measure recall at this size
BAND = 3  # lengths of a shard are within a factor of 2 ** BAND
QUERIES_PER_TASK = 100_000
TASKS_PER_GROUP = 4
BATCH = 128
STEPS_AT_ONCE = 20
NO_NODE = np.iinfo(np.int64).max  # odd, as nothing is open there


def _ordered(near: np.ndarray, node: np.ndarray) -> np.ndarray:
    """Similarity and node as one number that sorts by falling similarity, then by node; even, as the node is open."""
    bits = near.astype(np.float32).view(np.int32)
    rising = bits ^ ((bits >> 31) & 0x7FFFFFFF)
    return (~rising).astype(np.int64) << 32 | node.astype(np.int64) << 1


def _apart(ordered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes and similarities of such numbers; -1 and -inf where there is none."""
    rising = ~(ordered >> 32).astype(np.int32)
    near = (rising ^ ((rising >> 31) & 0x7FFFFFFF)).view(np.float32)
    none = ordered == NO_NODE
    return np.where(none, -1, (ordered & 0xFFFFFFFF) >> 1).astype(np.int32), np.where(none, np.float32(-np.inf), near)


def _in_rows(row: np.ndarray, count: int, *values: tuple[np.ndarray, int]) -> list[np.ndarray]:
    """Each of ``values``, sorted by row, as a matrix with a row's values in front and a filler behind."""
    wide = np.bincount(row, minlength=count)
    place = np.arange(len(row)) - (np.cumsum(wide) - wide)[row]
    out = []
    for value, filler in values:
        matrix = np.full((count, wide.max(initial=0)), filler, value.dtype)
        matrix[row, place] = value
        out.append(matrix)
    return out


def beam_search(
    vectors: np.ndarray, layer: np.ndarray, entry: np.ndarray, queries: np.ndarray, beam: int
) -> tuple[np.ndarray, np.ndarray]:
    """Numbers and similarities of the nodes each query's beam ends with, best first.

    A step looks at the neighbours of the best open nodes of each beam, and a search ends when
    no node of its beam is open. Work goes with the nodes that are reached, not with those of the
    graph. ``layer`` holds -1 where a node has fewer neighbours; so does the result.
    """
    count, size = len(queries), len(layer)
    seen = np.zeros(count * size, bool)
    best = np.full((count, beam), NO_NODE)
    best[:, 0] = _ordered(np.einsum("qd,qd->q", queries, vectors[entry]), entry)
    seen[np.arange(count) * size + entry] = True
    rows = np.arange(count)
    while len(rows):
        now = best[rows]
        open_ = (now & 1) == 0
        open_ &= np.cumsum(open_, axis=1, dtype=np.int32) <= STEPS_AT_ONCE
        r, c = np.nonzero(open_)
        reached = layer.take((now[r, c] & 0xFFFFFFFF) >> 1, axis=0)
        now[r, c] |= 1
        at = ((rows[r] * size)[:, None] + reached)[reached >= 0]
        at = np.sort(at[~seen.take(at)])
        at = at[np.diff(at, prepend=-1) > 0]
        seen[at] = True
        row = np.searchsorted(rows, at // size)
        node = at % size
        (table,) = _in_rows(row, len(rows), (node, 0))
        similar = (vectors.take(table, axis=0) @ queries[rows][:, :, None])[:, :, 0]
        found = _ordered(similar, table)
        found[np.arange(table.shape[1]) >= np.bincount(row, minlength=len(rows))[:, None]] = NO_NODE
        r, c = np.nonzero(found < now[:, -1:])
        (better,) = _in_rows(r, len(rows), (found[r, c], NO_NODE))
        now = np.sort(np.hstack([now, better]), axis=1)[:, :beam]
        best[rows] = now
        rows = rows[((now & 1) == 0).any(1)]
    return _apart(best)


def choose(vectors: np.ndarray, node: np.ndarray, near: np.ndarray, limit: int) -> np.ndarray:
    """Up to ``limit`` neighbours from candidates sorted by falling similarity, spread apart.

    A candidate is taken if it is nearer to the new node than to all taken before; free
    places go to the best of the others.
    """
    near_by = vectors.take(node, axis=0, mode="wrap")  # -1 is the last one, as in an index
    between = near_by @ near_by.transpose(0, 2, 1)
    valid = node >= 0
    taken = np.zeros(node.shape, bool)
    for c in range(node.shape[1]):
        blocked = (taken & (between[:, c] > near[:, c, None])).any(1)
        taken[:, c] = valid[:, c] & ~blocked & (taken.sum(1) < limit)
    rank = np.argsort(np.where(taken, 0, np.where(valid, 1, 2)), axis=1, kind="stable")[:, :limit]
    out = np.take_along_axis(np.where(valid, node, -1), rank, 1)
    return out if out.shape[1] == limit else np.pad(out, ((0, 0), (0, limit - out.shape[1])), constant_values=-1)


class Graph:
    """Vectors of equal length and one neighbour matrix per layer."""

    def __init__(self, vectors: np.ndarray, layers: list[np.ndarray]):
        self.vectors, self.layers = vectors, layers

    @classmethod
    def build(cls, vectors: np.ndarray, levels: np.ndarray, neighbours: int = NEIGHBOURS) -> Graph:
        """Vectors are sorted by falling level."""
        top = int(levels[0])
        sizes = [int((levels >= level).sum()) for level in range(top + 1)]
        layers = [np.full((n, neighbours * (1 if k else 2)), -1, np.int32) for k, n in enumerate(sizes)]
        graph = cls(vectors, layers)
        at, stops = 0, sorted({*sizes})
        while at < len(vectors):
            to = min(at + min(BATCH, max(8, at // 2)), next(s for s in stops if s > at))
            graph._insert(at, to)
            at = to
        return graph

    def _insert(self, at: int, to: int) -> None:
        new = np.arange(at, to, dtype=np.int32)
        queries = self.vectors[at:to]
        inside = queries @ queries.T
        np.fill_diagonal(inside, -np.inf)
        entry = np.zeros(len(new), np.int32)
        for layer in reversed(self.layers):
            if at >= len(layer):
                node, _ = beam_search(self.vectors, layer, entry, queries, 4)
                entry = node[:, 0]
                continue
            others = np.broadcast_to(new, inside.shape)
            if at:
                node, near = beam_search(self.vectors, layer, entry, queries, BEAM_BUILD)
                entry = node[:, 0]
                node, near = np.hstack([node, others]), np.hstack([near, inside])
            else:
                node, near = others, inside
            order = np.argsort(-near, axis=1, kind="stable")[:, :BEAM_BUILD]
            node, near = np.take_along_axis(node, order, 1), np.take_along_axis(near, order, 1).astype(np.float32)
            node = np.where(np.isfinite(near), node, -1)
            layer[at:to, :NEIGHBOURS] = choose(self.vectors, node, near, NEIGHBOURS)
            self._link_back(layer, new)

    def _link_back(self, layer: np.ndarray, new: np.ndarray) -> None:
        """Each new node becomes a neighbour of its neighbours; full ones choose again."""
        chosen = layer[new]
        r, c = np.nonzero(chosen >= 0)
        target, source = chosen[r, c], new[r]
        order = np.lexsort((source, target))
        target, source = target[order], source[order]
        heads = np.flatnonzero(np.concatenate([[True], target[1:] != target[:-1]])) if len(target) else target
        wide = np.diff(np.append(heads, len(target))) if len(target) else heads
        limit = layer.shape[1]
        for a in range(0, len(heads), BATCH):
            some, n = heads[a : a + BATCH], wide[a : a + BATCH]
            owner = target[some]
            added = np.full((len(some), n.max()), -1, np.int32)
            place = np.arange(n.max())[None, :] < n[:, None]
            added[place] = source[np.repeat(some - np.cumsum(n) + n, n) + np.arange(n.sum())]
            node = np.hstack([layer[owner], added])
            node.sort(axis=1)
            node[:, 1:][node[:, 1:] == node[:, :-1]] = -1
            near = (self.vectors.take(node, axis=0, mode="wrap") @ self.vectors[owner][:, :, None])[:, :, 0]
            near = np.where(node >= 0, near, -np.inf)
            order = np.argsort(-near, axis=1, kind="stable")
            node, near = np.take_along_axis(node, order, 1), np.take_along_axis(near, order, 1)
            few = (node >= 0).sum(1) <= limit
            out = np.full((len(some), limit), -1, np.int32)
            if few.any():
                part = node[few][:, :limit]
                out[few, : part.shape[1]] = part
            if (~few).any():
                out[~few] = choose(self.vectors, node[~few], near[~few], limit)
            layer[owner] = out

    def search(self, queries: np.ndarray, beam: int) -> np.ndarray:
        return self.search_scored(queries, beam)[0]

    def search_scored(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """The nodes found, with their similarities."""
        entry = np.zeros(len(queries), np.int32)
        for layer in reversed(self.layers[1:]):
            entry = beam_search(self.vectors, layer, entry, queries, 4)[0][:, 0]
        return beam_search(self.vectors, self.layers[0], entry, queries, beam)


def _same_length(vectors: np.ndarray) -> np.ndarray:
    """The vectors, brought below length 1 together, with a component more that makes them equally long."""
    vectors = vectors / np.abs(vectors).max()  # of any size, before they are squared
    vectors = vectors / np.sqrt((vectors * vectors).sum(1).max())
    square = (vectors * vectors).sum(1)
    rest = np.sqrt(np.maximum(square.max() - square, 0))
    return np.column_stack([vectors, rest]).astype(np.float32)


def _levels(count: int, seed: int) -> np.ndarray:
    draw = (mix(np.arange(1, count + 1, dtype=np.uint64) + np.uint64(seed << 32)) >> np.uint64(11)).astype(float)
    return np.sort(np.floor(-np.log((draw + 1) / 2**53) / np.log(NEIGHBOURS)).astype(int))[::-1]


GRAPH = "key long, dims long, vectors binary, ids binary, id_first binary, layers array<binary>"


def _build(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
    vectors = np.stack(rows.column("vector").combine_chunks().flatten().to_numpy().reshape(rows.num_rows, -1))
    order = np.lexsort(vectors.T[::-1])  # the same graph whatever order the rows come in
    lists = rows.column("ids").combine_chunks().take(pa.array(order))
    vectors = vectors[order]
    graph = Graph.build(_same_length(vectors), _levels(len(vectors), key[0].as_py() & 0xFFFF))
    first = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())]).astype(np.int64)
    return pa.table(
        {
            "key": pa.array([key[0].as_py()], pa.int64()),
            "dims": pa.array([vectors.shape[1]], pa.int64()),
            "vectors": packed([vectors.astype(np.float64)]),
            "ids": packed([lists.flatten().to_numpy()]),
            "id_first": packed([first]),
            "layers": pa.array([[layer.tobytes() for layer in graph.layers]], pa.list_(pa.binary())),
        }
    )


class Shard:
    """A shard's graph, read back, with the ids of its nodes."""

    def __init__(self, row: dict):
        self.exact = np.frombuffer(row["vectors"], np.float64).reshape(-1, row["dims"])
        self.ids = np.frombuffer(row["ids"], np.int64)
        self.first = np.frombuffer(row["id_first"], np.int64)
        nodes = len(self.exact)
        layers = []
        for k, layer in enumerate(row["layers"]):
            layers.append(np.frombuffer(layer, np.int32).reshape(-1, NEIGHBOURS * (1 if k else 2)))
        assert len(layers[0]) == nodes
        self.graph = Graph(_same_length(self.exact), layers)

    def nearest(self, queries: np.ndarray, k: int, beam: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Number of the query, id and exact score of the k best rows found here for each query, best first."""
        unit = queries / np.abs(queries).max(1, keepdims=True)  # the order of scores does not depend on it
        padded = np.column_stack([unit, np.zeros(len(queries))]).astype(np.float32)
        found, near = self.graph.search_scored(padded, min(beam, len(self.exact)))
        # Only nodes that may be among the k best by their exact scores are scored: a similarity is off by half of this at most.
        off = np.finfo(np.float32).eps * (padded.shape[1] + 8) * np.sqrt((unit * unit).sum(1))
        last = near[:, min(k, near.shape[1]) - 1]
        query, place = np.nonzero((found >= 0) & (near >= (last - 2 * off)[:, None]))
        node = found[query, place]
        score = np.einsum("nd,nd->n", queries[query], self.exact[node])
        rows = self.first[node + 1] - self.first[node]
        ids = self.ids[np.repeat(self.first[node] - np.cumsum(rows) + rows, rows) + np.arange(rows.sum())]
        query, score = np.repeat(query, rows), np.repeat(score, rows)
        order = np.lexsort((ids, -score, query))
        query, ids, score = query[order], ids[order], score[order]
        best = np.arange(len(query)) - np.searchsorted(query, query) < k
        return query[best], ids[best], score[best]


def usable(vectors: DataFrame, vector: str = "embedding") -> DataFrame:
    """(vec_id, vector as doubles) of the rows that take part."""
    v = F.col(vector).cast("array<double>")
    number = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return vectors.select("vec_id", v.alias("vector")).filter(
        F.col("vec_id").isNotNull() & F.forall("vector", number) & F.exists("vector", lambda x: x != 0)
    )


def _name(vector: Column) -> list[Column]:
    return [F.xxhash64(vector).alias("h1"), F.xxhash64(F.lit(1), vector).alias("h2")]


def build_index(rows: DataFrame, k: int) -> DataFrame:
    """Graphs (GRAPH) over all rows of ``usable``, for results of up to k rows beside the query's own."""
    # by name, as arrays are slow to sort and compare
    first = Window.partitionBy("h1", "h2").orderBy("vec_id")
    nodes, _ = stage(
        rows.select("vec_id", "vector", *_name(F.col("vector")))
        .withColumn("place", F.dense_rank().over(first))
        .filter(F.col("place") <= k + 1)
        .groupBy("h1", "h2")
        .agg(F.first("vector").alias("vector"), F.sort_array(F.collect_set("vec_id")).alias("ids"))
        .drop("h1", "h2"),
        "nodes",
    )
    shards = max(SHARDS, -(-nodes.count() // SHARD_NODES))
    dims = F.size("vector").cast("long")
    # Vectors of a shard are of like length: beside a much longer one all others would look the same.
    largest = F.array_max(F.transform("vector", F.abs))

    def length(most: Column) -> Column:  # in a lambda, so that it is found once per vector and not per component
        scaled = F.aggregate(F.transform("vector", lambda x: x / most), F.lit(0.0), lambda s, x: s + x * x)
        return F.log2(most) + F.log2(scaled) / 2

    # Length 1, the usual one, is in the middle of a band: at its end, rounding would deal unit vectors to two.
    band = F.floor(F.transform(F.array(largest), length)[0] / BAND + 0.5) + 1024
    key = (dims * 2048 + band) * shards + F.pmod(F.xxhash64("vector", F.lit(2)), F.lit(shards))
    built = _apart_by(nodes.withColumn("key", key), shards, "key").groupBy("key").applyInArrow(_build, GRAPH)
    return stage(built, "graphs")[0]


def _apart_by(df: DataFrame, groups: int, *key: str) -> DataFrame:
    """``df`` dealt by ``key``, which has about as many values as ``groups``, mostly one to a task.

    A group is much work on few bytes, so tasks are not to be joined by their bytes.
    """
    return df.repartition(groups * TASKS_PER_GROUP, *key)


def search_index(graphs: DataFrame, queries: DataFrame, k: int, beam: int = BEAM_SEARCH) -> DataFrame:
    """query_id, rank, vec_id, score for the rows of ``queries`` (vec_id, vector)."""
    named, _ = stage(queries.select("vec_id", "vector", *_name(F.col("vector"))), "queries")
    distinct = named.groupBy("h1", "h2").agg(F.first("vector").alias("query"))
    parts = -(-distinct.count() // QUERIES_PER_TASK) or 1
    part = F.pmod(F.xxhash64("h1", "h2"), F.lit(parts))
    keys = graphs.select("key", "dims")
    sent = distinct.withColumn("part", part).join(F.broadcast(keys), F.size("query") == F.col("dims"))
    nothing = {c: t for c, t in (x.split() for x in GRAPH.split(", "))}
    asks = sent.select(
        "key", "part", F.lit(1).alias("kind"), "h1", "h2", "query",
        *[F.lit(None).cast(t).alias(c) for c, t in nothing.items() if c not in ("key", "dims")], "dims",
    )
    holds = graphs.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))).select(
        "key", "part", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("h1"),
        F.lit(None).cast("long").alias("h2"), F.lit(None).cast("array<double>").alias("query"),
        "vectors", "ids", "id_first", "layers", "dims",
    )

    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = None
        for batch in batches:
            kind = take_column(batch, "kind").to_numpy()
            key = take_column(batch, "key").to_numpy()
            cut = np.flatnonzero((kind[1:] != kind[:-1]) | (key[1:] != key[:-1]) | (kind[1:] == 0)) + 1
            for a, b in zip(np.append(0, cut), np.append(cut, len(kind)), strict=True):
                some = batch.slice(a, b - a)
                if kind[a] == 0:
                    shard = Shard({c: take_column(some, c)[0].as_py() for c in ("dims", "vectors", "ids", "id_first", "layers")})
                    continue
                for at in range(0, some.num_rows, BATCH):
                    block = some.slice(at, BATCH)
                    asked = take_column(block, "query").flatten().to_numpy().reshape(block.num_rows, -1)
                    query, ids, scores = shard.nearest(asked, k + 1, beam)
                    h1, h2 = (take_column(block, name).to_numpy()[query] for name in ("h1", "h2"))
                    yield batch_of(h1=h1, h2=h2, vec_id=ids, score=scores)

    dealt = _apart_by(asks.unionByName(holds), max(graphs.count() * parts, 1), "key", "part")
    together = dealt.sortWithinPartitions("key", "part", "kind")
    found = together.mapInArrow(job, "h1 long, h2 long, vec_id long, score double")
    best = Window.partitionBy("h1", "h2").orderBy(F.desc("score"), "vec_id")
    merged = (
        found.withColumn("place", F.row_number().over(best))
        .filter(F.col("place") <= k + 1)
        .groupBy("h1", "h2")
        .agg(F.sort_array(F.collect_list(F.struct("place", "vec_id", "score"))).alias("found"))
    )
    own = named.select(F.col("vec_id").alias("query_id"), "h1", "h2").distinct()
    others = F.slice(F.filter("found", lambda x: x.vec_id != F.col("query_id")), 1, k)
    return (
        own.join(merged, ["h1", "h2"])
        .select("query_id", F.posexplode(others).alias("place", "hit"))
        .select("query_id", (F.col("place") + 1).cast("int").alias("rank"), "hit.vec_id", "hit.score")
    )


def nearest_neighbours(vectors: DataFrame, asking: Column, k: int = 20, beam: int = BEAM_SEARCH) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest other rows of each row for which ``asking`` holds."""
    rows = usable(vectors)
    return search_index(build_index(rows, k), rows.filter(asking), k, beam)


