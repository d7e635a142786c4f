"""Mixing sources to target weights by Pareto order sampling.

Each source gets a target number of words: its weight's share of all words, stopped at
``ceiling`` times its own words, the excess shared again by weight among the others. The
target is reached with whole documents: every document is taken ``floor(target / words)``
times for certain, and the rest of the target is a sample of the source's documents.

The sample is drawn by Pareto order sampling. A document's inclusion odds are the odds of
the remaining fraction times its size relative to the source's mean, so long documents are
likelier; its random odds come from a hash of its id. Documents are ranked by random odds
divided by inclusion odds and taken in that order as long as the words fit. The sample's
size in words is thus fixed beforehand. The place left over goes to the one document whose
size closes the gap best, if any does.

A document longer than the place left can cost a source much of its sample. The draw is therefore
repeated up to ``REFILLS`` times with the place left over, among the documents no larger than that, and a
source keeps what this gives if it comes nearer to the target.

Rank order within a source needs no task that holds the source: the rank statistic is cut
into ``BUCKETS`` ranges, words are summed per range, and only the range that the cut falls
into is sorted. Whatever sorts sources as a whole holds one row per source. Rows alike in id, source
and size are counted and numbered from their count, ``RUN`` at a time, so that no task gathers them.

Defined results: a null text has size 0 and is taken 0 words; a null source is a source,
the last one; rows that repeat are documents of their own; a source without words, and an
empty table, take nothing. Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from encore.llm.common import BROADCAST_ROWS, WORD
from encore.scratch import stage

WEIGHTS = (1, 2, 3)
CEILING = 3
REFILLS = 8  # draws after the first, among the documents that fit into what is left
BUCKETS = 4096
RUN = 1 << 16  # equal rows that are numbered in one go
KEY = ("doc_id", "source", "size", "repeat")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, ceiling: int = CEILING) -> DataFrame:
    """(source, source_size, weight, target) from rows (source, size).

    The level is the number of words per unit of weight. Sources above their ceiling leave
    it; the level of the others rises until no further one is above.
    """
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    place = (F.row_number().over(by_name) - 1) % len(weights)
    sources, _ = stage(
        sizes.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), place + 1)),
        "sources",
    )
    cap = F.col("source_size") * ceiling
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    level, open_weight = 0.0, sources.agg(F.sum("weight")).first()[0]
    left = total
    while open_weight:
        level = left / open_weight
        above = F.col("weight") * F.lit(level) > cap
        capped, still = sources.agg(
            F.sum(F.when(above, cap)), F.sum(F.when(~above, F.col("weight")))
        ).first()
        if (still or 0) == open_weight:
            break
        left, open_weight = total - (capped or 0), still or 0
    target = F.least(F.col("weight") * F.lit(level), cap.cast("double"))
    return sources.withColumn("target", target.cast("double"))


def numbered(docs: DataFrame) -> DataFrame:
    """KEY from rows (doc_id, source, size): equal rows are told apart by ``repeat``, from 1."""
    alike = ["doc_id", "source", "size"]
    counted, _ = stage(docs.groupBy(*alike).agg(F.count("*").alias("n")), "sizes")
    one, run = F.lit(1).cast("long"), F.lit(RUN).cast("long")
    few = counted.filter(F.col("n") <= run).withColumn("first", one)
    many = counted.filter(F.col("n") > run).withColumn("first", F.explode(F.sequence(one, "n", run)))
    runs = few.unionByName(many.repartition(*alike, "first"))
    return runs.select(*alike, F.explode(F.sequence("first", F.least("n", F.col("first") + run - one))).alias("repeat"))


def unit(*key: Column, seed: int) -> Column:
    """A number between 0 and 1, both excluded, from a hash of the key; the same in any run."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(k.cast("string"), F.lit("")) for k in key])
    digits = F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double")
    return (digits + 0.5) / F.lit(float(1 << 52))


def _draw(joins: DataFrame, small: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """joins (KEY, q, bucket, rest) with ``sampled``: the first by rank, as long as the words fit."""
    ahead = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    cut = (
        joins.groupBy("source", "bucket", "rest")
        .agg(F.sum("size").alias("words"))
        .withColumn("before", F.coalesce(F.sum("words").over(ahead), F.lit(0)))
        .filter("before < rest")
        .groupBy("source")
        .agg(F.max_by(F.struct("bucket", "before"), "bucket").alias("cut"))
        .select(F.col("source").alias("cut_source"), "cut.*")
        .withColumnRenamed("bucket", "cut_bucket")
    )
    by_rank = (
        Window.partitionBy("source")
        .orderBy("q", "doc_id", "repeat", "size")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    placed = joins.join(small(cut), F.col("source").eqNullSafe(F.col("cut_source")))
    at_cut = (
        placed.filter("bucket = cut_bucket")
        .withColumn("reached", F.col("before") + F.sum("size").over(by_rank))
        .withColumn("sampled", F.col("reached") <= F.col("rest"))
    )
    columns = [*KEY, "q", "bucket", "rest", "sampled"]
    return stage(
        placed.filter("bucket != cut_bucket")
        .withColumn("sampled", F.col("bucket") < F.col("cut_bucket"))
        .select(*columns)
        .unionByName(at_cut.select(*columns)),
        "drawn",
    )[0]


def _gaps(drawn: DataFrame, extra: DataFrame) -> DataFrame:
    """(gap_source, gap): what the documents in extra leave of the rest in drawn."""
    both = drawn.select("source", "rest", F.lit(0).cast("long").alias("words")).unionByName(
        extra.select("source", "rest", F.col("size").alias("words"))
    )
    return both.groupBy(F.col("source").alias("gap_source")).agg((F.max("rest") - F.sum("words")).alias("gap"))


def _closed(drawn: DataFrame, taken: DataFrame, small: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, str]:
    """(KEY, miss): by source the document that closes the gap best, null where none does, and the words then missed."""
    key = list(KEY)
    gaps = _gaps(drawn, taken)
    had = taken.select(*[F.col(c).alias(f"x_{c}") for c in key])
    free = drawn.join(had, [F.col(c).eqNullSafe(F.col(f"x_{c}")) for c in key], "left_anti")
    miss = F.abs(F.col("size") - F.col("gap"))
    closing = (
        free.join(small(gaps), F.col("source").eqNullSafe(F.col("gap_source")))
        .filter(miss < F.col("gap"))
        .groupBy(F.col("source").alias("c_source"))
        .agg(F.min_by(F.struct(*[c for c in key if c != "source"]), F.struct(miss, "q", *key)).alias("doc"), F.min(miss).alias("nearest"))
    )
    joined = gaps.join(closing, F.col("gap_source").eqNullSafe(F.col("c_source")), "left")
    return stage(
        joined.select(F.col("gap_source").alias("source"), "doc.*", F.coalesce("nearest", "gap").alias("miss")), "closing"
    )


def mix_sources(
    docs: DataFrame, weights=WEIGHTS, ceiling: int = CEILING, buckets: int = BUCKETS, seed: int = 1, refills: int = REFILLS
) -> DataFrame:
    """doc_id, size, source, source_size, target, copies, taken: one row per document."""
    plain = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"))
    sized = numbered(plain)
    targets = source_targets(sized, weights, ceiling)
    n_docs = sized.groupBy("source").agg(F.count(F.when(F.col("size") > 0, 1)).alias("n_docs"))
    # one row per source: broadcast unless there are very many
    small = F.broadcast if targets.count() <= BROADCAST_ROWS else (lambda df: df)
    plan = targets.join(n_docs, targets.source.eqNullSafe(n_docs.source)).drop(n_docs.source)
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    plan = (
        plan.withColumn("certain", F.floor(ratio))
        .withColumn("rest", F.col("target") - F.col("certain") * F.col("source_size"))
        .withColumn("fraction", ratio - F.col("certain"))
    )
    random_odds = F.col("u") / (1 - F.col("u"))
    inclusion_odds = (
        F.col("fraction")
        / (1 - F.col("fraction"))
        * F.try_divide(F.col("size") * F.col("n_docs"), F.col("source_size"))
    )
    ranked, _ = stage(
        sized.join(small(plan), sized.source.eqNullSafe(plan.source))
        .drop(plan.source)
        .withColumn("u", unit(F.col("doc_id"), F.col("repeat"), seed=seed))
        .withColumn("q", F.when(inclusion_odds > 0, random_odds / inclusion_odds))
        .withColumn("bucket", F.floor(F.col("q") / (1 + F.col("q")) * buckets)),
        "ranked",
    )
    key = list(KEY)
    drawn = _draw(ranked.filter("q is not null"), small)
    extra = drawn.filter("sampled")
    unfilled = drawn
    for _ in range(refills):
        gaps = _gaps(unfilled, unfilled.filter("sampled"))
        fits = unfilled.filter("not sampled").join(small(gaps), F.col("source").eqNullSafe(F.col("gap_source")))
        fits, _ = stage(fits.filter("size <= gap").select(*key, "q", "bucket", F.col("gap").alias("rest")), "fits")
        if fits.isEmpty():
            break
        unfilled = _draw(fits, small)
        extra = extra.unionByName(unfilled.filter("sampled"))
    first, _ = _closed(drawn, drawn.filter("sampled"), small)
    last, _ = _closed(drawn, extra, small)
    # per source, whether going on came nearer
    best = first.select(F.col("source").alias("a_source"), F.col("miss").alias("miss")).join(
        last.select(F.col("source").alias("b_source"), F.col("miss").alias("refilled_miss")),
        F.col("a_source").eqNullSafe(F.col("b_source")),
    )
    best, _ = stage(best.select(F.col("a_source").alias("best_source"), (F.col("refilled_miss") < F.col("miss")).alias("refilled")), "best")

    def of(rows: DataFrame, refilled: bool) -> DataFrame:
        chosen = best.filter(F.col("refilled") if refilled else ~F.col("refilled"))
        return rows.join(small(chosen), F.col("source").eqNullSafe(F.col("best_source"))).select(*key)

    closing = [c.filter("size is not null") for c in (first, last)]
    extra = (
        of(drawn.filter("sampled"), False)
        .unionByName(of(closing[0], False))
        .unionByName(of(extra, True))
        .unionByName(of(closing[1], True))
    )
    extra = extra.select(*[F.col(c).alias(f"x_{c}") for c in key])
    hit = [F.col(c).eqNullSafe(F.col(f"x_{c}")) for c in key]
    copies = F.col("certain") + F.when(F.col("x_repeat").isNotNull(), 1).otherwise(0)
    return (
        ranked.join(extra, hit, "left")
        .withColumn("copies", F.when(F.col("size") > 0, copies).otherwise(0).cast("long"))
        .select(
            "doc_id", "size", "source", "source_size", "target", "copies",
            (F.col("copies") * F.col("size")).alias("taken"),
        )
    )
