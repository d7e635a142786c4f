"""Exact Jaccard self-join on 5-word shingles, with size-banded tiles and bitmap signatures.

Two documents link when 100 * |A & B| >= 75 * |A | B|. No link between different sets is
lost, and no pair is emitted that could be inferred: the result is one row per document
with the component it belongs to.

1. *Sets.* A document is the set of the 64-bit hashes of its shingles. Equal sets are one
   node, named by a fingerprint of the set; a second fingerprint guards it (the job fails
   rather than mix two sets up). Copies, however many, take part once.
2. *Tiles.* Sets that link share a shingle among the first ``|A| - ceil(0.75 |A|) + 1`` of
   either one, in any order of all shingles. Shingles are ordered by hash; nodes that share
   one of those first shingles and whose sizes allow a link form a tile, a run of sizes
   without a gap wider than 3 : 4. Tiles of the same nodes are one.
   Shingles that many documents hold (``HOT``) would make large tiles. They are put last in
   the order, so that a text with a passage all others have is sought by the rest of it. The
   texts this concerns are gone through again, and the shingles that may come up in their
   place are counted beforehand, twice as far as the share of hot ones calls for. Any set of hot shingles gives a valid order, so the threshold
   is doubled until they fit ``MAX_HOT``, which bounds their broadcast.
3. *Bitmaps.* In a tile all pairs in reach are compared by bitmaps with a bit for each hash,
   set by the parity of the shingles that fall on it, one to two bits per shingle. The
   number of differing bits is at most the size of the symmetric difference, so it bounds
   the overlap from above. What is left are possible links; as many of them as connect the
   nodes of a tile are emitted, and their components are the groups to verify.
4. *Verification.* Each node's array goes to its group once, and exact intersections say
   which nodes link, block by block (``verify.py``).
5. Texts made of hot shingles for the most part, such as thousands of edited copies of one,
   are grouped by hot shingle and band of size instead, and verified in the same way: first
   in one group each, then in all groups that still hold different components.

Defined results: a null or empty text has no shingles and is its own component; a text of
fewer than five words is one shingle; a row with a null doc_id has a null component; rows
that share a doc_id are looked at by their own texts. Empty tables give empty results.
Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.llm.common import arrow_map, batch_of, flat, packed, take_column
from encore.llm.components import components
from encore.llm.membership import Filter
from encore.llm.textarrays import mix, signed
from encore.llm.verify import arrays, bitmap, by_key, fingerprint, possible_links, shingle_sets, spread, verify_groups
from encore.scratch import stage

PERCENT = 75
HOT = 1024
MAX_HOT = 2_000_000


def prefix_length(n: np.ndarray | int, percent: int = PERCENT):
    return n - -(-percent * n // 100) + 1


def _profiles(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    n = np.zeros(batch.num_rows, np.int64)
    node, guard = n.copy(), n.copy()
    empty = np.zeros(0, np.uint64)
    prefix, maps = [empty] * len(n), [empty] * len(n)
    for r, values in shingle_sets(batch):
        n[r] = len(values)
        node[r], guard[r] = fingerprint(values)
        prefix[r], maps[r] = values[: prefix_length(len(values))], bitmap(values)
    yield batch_of(
        doc_id=take_column(batch, "doc_id"), n=n, node=pa.array(node, mask=n == 0), guard=guard,
        prefix=packed(prefix), bitmap=packed(maps),
    )


def _counts(df: DataFrame, pick: Callable[[pa.RecordBatch], np.ndarray]) -> DataFrame:
    """(token, n): in how many rows each picked token is."""

    def job(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        token, n = np.unique(pick(batch), return_counts=True)
        yield batch_of(token=signed(token), n=n)

    return arrow_map(df, job, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))


def _hot(counts: DataFrame, known: np.ndarray, hot: int) -> np.ndarray:
    """The tokens above the threshold, joined with those known."""
    found, _ = stage(counts.filter(F.col("n") > hot), "hot-shingles", gathered=True)
    while found.filter(F.col("n") > hot).count() > MAX_HOT:
        hot *= 2
    rows = found.filter(F.col("n") > hot).toArrow()
    return np.union1d(known, np.ascontiguousarray(rows.column("token").to_numpy()).view(np.uint64))


def _member(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(values), bool)
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def _ordered_prefix(values: np.ndarray, hot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first tokens with hot ones last: (common ones, hot ones among them)."""
    is_hot = _member(values, hot)
    need = prefix_length(len(values))
    plain = values[~is_hot][:need]
    return plain, values[is_hot][: need - len(plain)]


def _rows_of(batch: pa.RecordBatch, name: str) -> Iterator[tuple[int, np.ndarray]]:
    values, first = flat(take_column(batch, name))
    for r in range(batch.num_rows):
        if first[r + 1] > first[r]:
            yield r, values[first[r] : first[r + 1]]


POSTING = "token long, node long, n long, hot long"


def _posting_batch(found: list[tuple[int, int, np.ndarray]], hot: bool = False) -> Iterator[pa.RecordBatch]:
    """POSTING rows of (node, n, tokens). Those of hot tokens are dealt out by node, and not by token."""
    if found:
        nodes, sizes, tokens = zip(*found, strict=True)
        many = [len(t) for t in tokens]
        node, token = np.repeat(np.array(nodes, np.int64), many), signed(np.concatenate(tokens))
        none = np.zeros(len(token), np.int64)
        yield batch_of(
            token=signed(mix(node.view(np.uint64))) if hot else token, node=node, n=np.repeat(sizes, many),
            hot=token if hot else none,
        )


def _postings(profiles: DataFrame, common: np.ndarray, rare: np.ndarray) -> DataFrame:
    """The first tokens by hash of each text but the hot ones.

    Of the texts that ``common`` concerns, the second order brings all others but those it puts last.
    """

    def job(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        node, n = take_column(batch, "node").to_numpy(), take_column(batch, "n").to_numpy()
        found = []
        for r, values in _rows_of(batch, "prefix"):
            is_hot = _member(values, common)
            if is_hot.any():
                values = values[~is_hot & _member(values, rare)]
            found.append((node[r], n[r], values))
        yield from _posting_batch(found)

    return arrow_map(profiles, job, POSTING)


def _concerned(batch: pa.RecordBatch, common: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(node, values) of the distinct sets with a hot shingle among their first ones."""
    seen: set[int] = set()
    for _, values in shingle_sets(batch):
        if _member(values[: prefix_length(len(values))], common).any():
            node, _ = fingerprint(values)
            if node not in seen:
                seen.add(node)
                yield node, values


def _coming(text: DataFrame, common: np.ndarray) -> DataFrame:
    """(token, n) of what may come first in the texts that ``common`` concerns, if hot tokens go last.

    The share of hot ones among the first tokens says how far that will be; twice as far is looked.
    """

    def pick(batch: pa.RecordBatch) -> np.ndarray:
        found = [np.zeros(0, np.uint64)]
        for _, values in _concerned(batch, common):
            need = prefix_length(len(values))
            hot = int(_member(values[:need], common).sum())
            found.append(values[need : need + 2 * need * hot // max(need - hot, 1) + 8])
        return np.concatenate(found)

    return _counts(text, pick)


def _second_postings(text: DataFrame, common: np.ndarray, rare: np.ndarray) -> DataFrame:
    """The first tokens of the texts that ``common`` concerns, in the order that puts ``rare`` last."""

    def job(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        plain, hot = [], []
        for node, values in _concerned(batch, common):
            one, two = _ordered_prefix(values, rare)
            plain.append((node, len(values), one))
            if len(two):
                hot.append((node, len(values), two))
        yield from _posting_batch(plain)
        yield from _posting_batch(hot, hot=True)

    return arrow_map(text, job, POSTING)


def _tiles(table: pa.Table) -> Iterator[pa.RecordBatch]:
    """(tile, node, n, hot) from postings: runs of like size, named by the set of their nodes.

    Postings of hot tokens go on as they are.
    """
    token, node, n, hot = (table.column(c).to_numpy() for c in ("token", "node", "n", "hot"))
    passing = hot != 0
    if passing.any():
        yield batch_of(tile=hot[passing], node=node[passing], n=n[passing], hot=np.ones(passing.sum(), bool))
        token, node, n = token[~passing], node[~passing], n[~passing]
    if not len(token):
        return
    order = np.lexsort((node, n, token))
    token, node, n = token[order], node[order], n[order]
    again = np.zeros(len(token), bool)
    again[1:] = (token[1:] == token[:-1]) & (node[1:] == node[:-1])
    token, node, n = token[~again], node[~again], n[~again]
    start = np.ones(len(token), bool)
    start[1:] = (token[1:] != token[:-1]) | (100 * n[:-1] < PERCENT * n[1:])
    head = np.flatnonzero(start)
    size = np.diff(np.append(head, len(token)))
    one = mix(np.ascontiguousarray(node).view(np.uint64))
    name = mix(np.add.reduceat(one, head) + size.astype(np.uint64))
    keep = np.repeat(size > 1, size)
    name, node, n = np.repeat(name, size)[keep], node[keep], n[keep]
    order = np.lexsort((node, name))  # the same tile by several tokens
    name, node, n = name[order], node[order], n[order]
    new = np.ones(len(name), bool)
    new[1:] = (name[1:] != name[:-1]) | (node[1:] != node[:-1])
    yield batch_of(tile=signed(name[new]), node=node[new], n=n[new], hot=np.zeros(new.sum(), bool))


def _hot_groups(hot: DataFrame) -> DataFrame:
    """(token, tile, node): the groups of texts of hot shingles by shingle and band of size."""
    band = F.floor(F.log("n") / F.lit(float(np.log(100 / PERCENT))))
    banded = hot.select(F.col("tile").alias("token"), "node", F.explode(F.array(band, band + 1)).alias("band"))
    return banded.select("token", F.xxhash64("token", "band").alias("tile"), "node")


def near_duplicates(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """doc_id, n_shingles, component_id: one row per document."""
    text = docs.select("doc_id", "text")
    profiles, _ = stage(arrow_map(
        text, _profiles, "doc_id long, n long, node long, guard long, prefix binary, bitmap binary"
    ), "profiles")
    known = profiles.filter("n > 0 and doc_id is not null")
    nodes, _ = stage(
        known.groupBy("node", "n")
        .agg(F.min("doc_id").alias("rep"), F.min("guard").alias("low"), F.max("guard").alias("high"), F.max("bitmap").alias("bitmap"))
        .withColumn("rep", F.when(F.col("low") == F.col("high"), F.col("rep")).otherwise(
            F.raise_error(F.lit("two sets share a fingerprint")).cast("long")))
        .drop("low", "high"),
        "nodes",
    )

    # shingles too common to seek by, and what takes their place in the texts they concern
    seen = text.filter("doc_id is not null").select("text")
    common = _hot(_counts(known, lambda b: flat(take_column(b, "prefix"))[0]), np.zeros(0, np.uint64), hot)
    rare = common
    if len(common):
        rare = _hot(_coming(seen, common), common, hot)

    postings = _postings(known, common, rare)
    if len(common):
        postings = postings.unionByName(_second_postings(seen, common, rare))
    size = known.agg(F.sum(F.length("prefix") / 8)).first()[0] or 0
    raw = spread(postings, "token", 32 * int(size)).mapInArrow(by_key("token", _tiles), "tile long, node long, n long, hot boolean")
    every, _ = stage(raw.distinct(), "tiles")
    tiles = every.filter("not hot").drop("hot")
    weighed = nodes.select("node", (F.length("bitmap") + 32).alias("weight"))
    weight = tiles.join(weighed, "node").agg(F.sum("weight")).first()[0] or 0
    compared = spread(tiles.join(nodes.select("node", "bitmap"), "node"), "tile", int(weight))
    possible, _ = stage(compared.mapInArrow(possible_links(PERCENT), "a long, b long"), "possible", gathered=True)
    groups, _ = stage(components(possible).select(F.col("component").alias("tile"), "node"), "groups")
    wanted = groups.select("node")
    if len(common):
        hot_groups = _hot_groups(every.filter("hot"))
        wanted = wanted.unionByName(hot_groups.select("node"))
    sets, _ = stage(arrays(seen, Filter.of(wanted)), "arrays")
    links = verify_groups(groups, groups, sets, possible.limit(0), PERCENT)
    if len(common):
        own = hot_groups.groupBy("node").agg(F.min_by("tile", F.struct("token", "tile")).alias("tile"))
        links = verify_groups(own.select("tile", "node"), hot_groups.select("tile", "node"), sets, links, PERCENT)
    parts = components(links).join(nodes.select("node", "rep"), "node")
    least = parts.groupBy("component").agg(F.min("rep").alias("least"))
    least = parts.join(least, "component").select("node", "least")
    return (
        profiles.select("doc_id", "n", "node")
        .join(nodes.select("node", "rep"), "node", "left")
        .join(least, "node", "left")
        .select(
            "doc_id", F.col("n").alias("n_shingles"),
            F.when(F.col("doc_id").isNotNull(), F.coalesce("least", "rep", "doc_id")).alias("component_id"),
        )
    )


def one_of_each(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """The documents with the smallest doc_id of their component; those without an id stay."""
    found = near_duplicates(docs.select("doc_id", "text"), hot)
    gone = found.filter("doc_id != component_id").select(F.col("doc_id").alias("_encore_gone")).distinct()
    return docs.join(gone, F.col("doc_id") == F.col("_encore_gone"), "left_anti")


