"""A Merkle manifest of a table: digests of rows, of sources and of the whole, with proofs.

A row's leaf is the SHA-256 of its columns, each written as its length in bytes and its value, so
that no two rows look alike. The leaves of a source in order of doc_id are its tree: every
``FANOUT`` nodes that follow each other become their digest, level by level, until one is
left, the subroot. The subroots in order of their sources are a tree of the same kind, whose
last node is the root. A proof is all siblings on the way from a leaf to the root; folding
them with the leaf gives the root again, unless the row was changed.

Method, per level:

1. Rows have a place in their tree from one range shuffle over (source, doc_id, leaf) and
   running sums, so a source of any size is many tasks. A window covers a block of
   ``FANOUT ** 2`` consecutive places.
2. In it ``lag`` and ``lead`` at the fixed offsets 1 to ``FANOUT - 1``, masked by the slot
   in the run and by the run's length, are the siblings to the left and to the right.
3. The first row of a run has all its siblings ahead and gives the parent: the next level is
   these rows, a sixteenth as many, and is written before it is used.

On the way down a node's path is its own siblings and the path of its parent. Leaves do not keep
their siblings: the last job has the window again, meets one row per block with the paths of
its runs, and folds. Everything is DataFrame functions.

Defined results: columns that are null are written as ``-``; rows without doc_id come first,
rows that share one are ordered by their leaves (equal rows are interchangeable); rows without
doc_id are not tampered with; null is a source of its own, before all others. An empty text
differs from a null one. Columns beyond the five are ignored, and missing ones are null. The
root of a table with one row is its leaf; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from encore.llm.common import lower_ascii
from encore.operators.identity import with_offsets
from encore.scratch import discard, stage

FANOUT = 16
BLOCK = FANOUT * FANOUT
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
TAMPER = 5  # rows whose crc32 of doc_id this divides


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def encoded(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(fields: dict[str, Column]) -> Column:
    return digest(*[encoded(fields[name]) for name in FIELDS])


def _leaves(docs: DataFrame) -> DataFrame:
    """(doc_id, source, leaf, changed): ``changed`` is the leaf after tampering, null where nothing is done."""
    fields = {n: F.col(n) if n in docs.columns else F.lit(None).cast("string") for n in FIELDS}
    chosen = F.crc32(fields["doc_id"].cast("string").cast("binary")) % TAMPER == 0
    tampered = leaf_of({**fields, "text": lower_ascii(fields["text"])})
    return docs.select(
        fields["doc_id"].cast("long").alias("doc_id"), fields["source"].alias("source"),
        leaf_of(fields).alias("leaf"), F.when(chosen, tampered).alias("changed"), F.rand(11).alias("salt"),
    )


def _with_siblings(nodes: DataFrame) -> DataFrame:
    """Rows (tree, place, n, digest) with ``left`` and ``right``, their siblings' digests in order.

    Windows hold the nodes of a block, which begins with a run, so no tree is gathered anywhere.
    """
    slot = F.col("place") % FANOUT
    length = F.least(F.lit(FANOUT), F.col("n") - F.col("place") + slot)
    nodes = nodes.withColumn("block", F.floor(F.col("place") / BLOCK).cast("long"))
    order = Window.partitionBy("tree", "block").orderBy("place")
    before = [F.when(slot >= k, F.lag("digest", k).over(order)) for k in range(FANOUT - 1, 0, -1)]
    after = [F.when(slot + k < length, F.lead("digest", k).over(order)) for k in range(1, FANOUT)]
    return nodes.select("*", F.concat_ws("", *before).alias("left"), F.concat_ws("", *after).alias("right"))


def _parents(nodes: DataFrame) -> DataFrame:
    """The next level: each run's first child has all others to its right."""
    first = nodes.filter(F.col("place") % FANOUT == 0)
    return first.select(
        "tree", F.floor(F.col("place") / FANOUT).cast("long").alias("place"),
        F.ceil(F.col("n") / FANOUT).cast("long").alias("n"), digest(F.col("digest"), F.col("right")).alias("digest"),
    )


def _climb(nodes: DataFrame, largest: int, used: list[str]) -> tuple[list[DataFrame], DataFrame]:
    """The levels above ``nodes`` (tree, place, n, digest), with siblings, and (tree, digest) of the roots.

    A tree's last node is in the level where it is the only one of its tree.
    """
    levels, now, width = [], nodes, largest
    while width > 1:
        above = _parents(_with_siblings(now.filter("n > 1")))
        now, path = stage(above, "merkle-level")
        used.append(path)
        levels.append(now)
        width = -(-width // FANOUT)
    roots = [level.filter("n = 1").select("tree", "digest") for level in (nodes, *levels)]
    found = roots[0]
    for more in roots[1:]:
        found = found.unionByName(more)
    return levels, found


STEP = "array<struct<left:string,right:string>>"


def _descend(levels: list[DataFrame], roots: DataFrame, used: list[str]) -> DataFrame:
    """(tree, place, path) of the lowest of ``levels``, which is level 1; ``roots`` has (tree, path) of the last nodes.

    A path lists the siblings from a node up to the root of all.
    """
    above = None
    for level in reversed(levels):
        tops = level.filter("n = 1").join(roots, "tree").select("tree", "place", "path")
        if above is not None:
            step = F.array(F.struct("left", "right"))
            inner = _with_siblings(level.filter("n > 1")).withColumn("up", F.floor(F.col("place") / FANOUT).cast("long"))
            parents = above.select("tree", F.col("place").alias("up"), F.col("path").alias("rest"))
            inner = inner.join(parents, ["tree", "up"]).select("tree", "place", F.concat(step, "rest").alias("path"))
            tops = tops.unionByName(inner)
        above, path = stage(tops, "merkle-paths")
        used.append(path)
    return above


def _fold(leaf: Column, path: Column) -> Column:
    return F.aggregate(path, leaf, lambda now, step: digest(step["left"], now, step["right"]))


def _packed(paths: DataFrame) -> DataFrame:
    """One row per block of nodes a level below: the paths of its at most FANOUT parents, by slot."""
    block = F.floor(F.col("place") / FANOUT).cast("long").alias("block")
    found = F.sort_array(F.collect_list(F.struct((F.col("place") % FANOUT).alias("slot"), "path")))
    return paths.groupBy("tree", block).agg(found.alias("found")).select("tree", "block", F.col("found.path").alias("paths"))


def _placed(rows: DataFrame, order: list[str], tree: str | None, used: list[str]) -> DataFrame:
    """``rows`` with ``tree``, ``place`` in it and ``n``, its number of nodes; trees by the given column, or one tree."""
    numbered, path = with_offsets(rows.withColumn("_one", F.lit(1).cast("long")), order, "_one", "_at", "_range")
    used.append(path)
    numbered, path = stage(numbered.drop("_one", "_range"), "merkle-order")
    used.append(path)
    if tree is None:
        one_tree = {"tree": F.lit(0).cast("long"), "n": F.lit(numbered.count()).cast("long")}
        return numbered.withColumns(one_tree).withColumnRenamed("_at", "place")
    sizes = numbered.groupBy(F.col(tree).alias("_key")).agg(F.min("_at").alias("tree"), F.count("*").alias("n"))
    joined = numbered.join(sizes, F.col(tree).eqNullSafe(F.col("_key"))).drop("_key")
    return joined.withColumn("place", F.col("_at") - F.col("tree")).drop("_at")


def manifest(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified: one row per row of ``docs``."""
    used: list[str] = []
    spark = docs.sparkSession
    leaves, path = stage(_leaves(docs), "merkle-leaves")
    used.append(path)
    placed = _placed(leaves, ["source", "doc_id", "leaf", "salt"], "source", used)
    rows, path = stage(placed.drop("source", "salt").withColumnRenamed("leaf", "digest"), "merkle-rows")
    used.append(path)
    largest = rows.agg(F.max("n")).first()[0] or 0
    levels, subroots = _climb(rows.select("tree", "place", "n", "digest"), largest, used)

    # the tree of subroots: trees are named by their first row's number, which orders them as their sources
    subroots, path = stage(subroots, "merkle-subroots")
    used.append(path)
    top = _placed(subroots.withColumnRenamed("tree", "source_tree"), ["source_tree"], None, used)
    top, path = stage(top, "merkle-top")
    used.append(path)
    wide = top.agg(F.max("n")).first()[0] or 0
    top_levels, roots = _climb(top.select("tree", "place", "n", "digest"), wide, used)
    last = roots.first()  # the only one
    root = F.lit(last["digest"] if last else None).cast("string")
    nothing = F.array().cast(STEP)
    to_top = _paths_of(top, top_levels, roots.select("tree", nothing.alias("path")), used).select(
        F.col("source_tree").alias("tree"), F.col("digest").alias("subroot"), "path"
    )
    to_top, path = stage(to_top.withColumn("root", root), "merkle-sources")
    used.append(path)

    found = _paths_of(rows, levels, to_top.select("tree", "path"), used)
    sources = to_top.drop("path")
    shown = found.join(sources, "tree")
    proof = F.aggregate("path", F.lit("").cast("string"), lambda text, step: F.concat(text, step["left"], step["right"]))
    shown = shown.select(
        "doc_id", F.col("digest").alias("leaf"), "subroot", "root", digest(proof).alias("proof_sha256"),
        _fold(F.coalesce("changed", "digest"), F.col("path")).alias("folded_root"),
    )
    result, _ = stage(shown, "merkle-manifest")
    for path in used:
        discard(spark, path)
    return result.withColumn("verified", F.col("folded_root") == F.col("root"))


def _paths_of(rows: DataFrame, levels: list[DataFrame], roots: DataFrame, used: list[str]) -> DataFrame:
    """``rows`` (tree, place, n, digest) with the path to the root; ``roots`` has (tree, path) of the last nodes.

    The rows stay where their window put them: what they meet has one row per block.
    """
    alone = roots.select("tree", F.lit(0).cast("long").alias("block"), F.array("path").alias("paths"))
    if not levels:
        packed = alone
    else:
        single = rows.filter("n = 1").select("tree")
        packed = _packed(_descend(levels, roots, used)).unionByName(alone.join(single, "tree", "left_semi"))
    around = _with_siblings(rows).join(packed, ["tree", "block"])
    up = F.floor(F.col("place") / FANOUT) - F.col("block") * FANOUT
    rest = F.get("paths", up.cast("int"))
    own = F.when(F.col("n") > 1, F.array(F.struct("left", "right"))).otherwise(F.array().cast(STEP))
    return around.select(*rows.columns, F.concat(own, rest).alias("path"))
