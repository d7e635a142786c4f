"""Passages that repeat across documents, by a sparse suffix array.

Of all suffixes only those are kept that begin at minimisers: a word position is selected if
its hash of ``GRAM`` words is the smallest of some ``WINDOW`` neighbouring ones. The choice
depends on the words alone, so any run of ``LEAST`` = GRAM + WINDOW - 1 words has a selected
position, the same one in all its copies. Of a run of equal grams (one word over and over) the
first and the last position are kept and every ``STRIDE``-th between, so that each such run of
words still has one whose gram it holds, and matches along the run overlap.

A first pass counts the hashes at selected positions; those of one document only can't begin
a repeated passage. A second pass writes the remaining suffixes, each with the ``REACH``
words before and after its position. They are sorted as a whole, once by the words that
follow and once by those that precede, going backwards, so that the longest matches to
either side are neighbours. They are dealt out by ranges of the sort key, which ends with
document and position, so a passage that a third of the documents share is spread over many
tasks, each of which sees sorted neighbours. Suffixes of one text that agree in all words on both sides are one
row with all its positions, so a text that repeats a passage doesn't fill ranges with it.
Where ranges meet, the first and the last suffixes of each range are compared once more, by range,
with what the ranges before and after hand on: ``NEIGHBOURS`` rows and the nearest one
of another document or gram. Only those few rows of each range come together in one task.

Each suffix is compared with its neighbours of other documents. Equal words to the right
and, going left, before the position make a match; at least ``LEAST`` words together make a
repeated passage. The best neighbours to the right and to the left bound what any document can
share with a suffix; where a window of ``LEAST`` words is within both bounds and no match covers
it, the suffix's windows are looked up, by 64-bit hashes, among those of all suffixes. So a
passage is found whole though neither of its best neighbours holds it. Passages longer than the reach have further selected
positions, whose matches overlap, and are joined to one. Words are compared by 32-bit
hashes behind an equal 64-bit hash of ``GRAM`` words.

Result: for each document the spans of words (numbered from 0, end exclusive) that also
stand in some other document, with the smallest doc_id that a span was matched with.
Defined results: texts of fewer than LEAST words, null and empty ones have none; a row with
a null doc_id is left out; rows that share a doc_id are one document and don't match each
other. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from encore.llm.common import arrow_map, batch_of, take_column, whole_partition
from encore.llm.membership import Filter
from encore.llm.textarrays import Slice, mix, shingles, signed, slices, words
from encore.scratch import stage

LEAST = 50
GRAM = 12
WINDOW = LEAST - GRAM + 1
REACH = LEAST
STRIDE = REACH // 2
NEIGHBOURS = 4


def _slide(values: np.ndarray, width: int, best) -> np.ndarray:
    """best(values[i], ..., values[i + width - 1]) for each i that has that many."""
    done, size = values, 1
    while size * 2 <= width:
        done = best(done[:-size], done[size:])
        size *= 2
    return best(done[: len(done) - (width - size)], done[width - size :]) if size < width else done


def minimisers(s: Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, word number in the row, gram; then all word hashes and where rows begin in them."""
    w = words(s.lower())
    grams, first = shingles(w, GRAM)
    row, place, gram = [], [], []
    for r in range(len(s)):
        if w.first[r + 1] - w.first[r] < LEAST:
            continue
        values = grams[first[r] : first[r + 1]]
        least = _slide(values, WINDOW, np.minimum)
        edge = np.zeros(WINDOW - 1, np.uint64)
        most = _slide(np.concatenate([edge, least, edge]), WINDOW, np.maximum)
        chosen = values == most
        at = np.flatnonzero(chosen)
        # of a word that goes on repeating the first, the last and some positions between
        turn = np.flatnonzero(values[1:] != values[:-1]) + 1
        head = np.concatenate([[0], turn])
        run = np.searchsorted(turn, at, "right")
        last = np.append(turn, len(values))[run] - 1
        at = at[((at - head[run]) % STRIDE == 0) | (at == last)]
        row.append(np.full(len(at), r))
        place.append(at)
        gram.append(values[at])
    if not row:
        none = np.zeros(0, np.int64)
        return none, none, none.view(np.uint64), w.hash, w.first
    return np.concatenate(row), np.concatenate(place), np.concatenate(gram), w.hash, w.first


def _grams(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    ids = take_column(batch, "doc_id").to_numpy()
    for s in slices(take_column(batch, "text")):
        row, _, gram, _, _ = minimisers(s)
        yield batch_of(gram=signed(gram), doc_id=ids[s.first + row])


SUFFIX = "gram long, right binary, left binary, doc_id long, place long, more array<bigint>"


def suffixes(docs: DataFrame, wanted: Filter) -> DataFrame:
    """The selected suffixes whose gram passes the filter, with the words on both sides.

    ``left`` goes backwards from the position. Where a text ends, words are missing. Positions of
    a text whose words agree on both sides are one row: the first of them, and ``more`` (else null).
    """

    def job(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        ids = take_column(batch, "doc_id").to_numpy()
        for s in slices(take_column(batch, "text")):
            row, place, gram, word, first = minimisers(s)
            keep = wanted.has(signed(gram)) if len(gram) else np.zeros(0, bool)
            row, place, gram = row[keep], place[keep], gram[keep]
            if not len(row):
                continue
            word = (mix(word) >> np.uint64(32)).astype(">u4")
            at = first[row] + place
            right = [word[a:b].tobytes() for a, b in zip(at, np.minimum(at + REACH, first[row + 1]), strict=True)]
            left = [word[b:a][::-1].tobytes() for a, b in zip(at, np.maximum(at - REACH, first[row]), strict=True)]
            places: dict[tuple, list[int]] = {}
            for key, p in zip(zip(row.tolist(), gram.tolist(), right, left, strict=True), place.tolist(), strict=True):
                places.setdefault(key, []).append(p)
            row, gram, right, left = map(list, zip(*places, strict=True))
            yield batch_of(
                gram=signed(np.array(gram, np.uint64)), right=pa.array(right, pa.binary()), left=pa.array(left, pa.binary()),
                doc_id=ids[s.first + np.array(row)], place=pa.array([p[0] for p in places.values()], pa.int64()),
                more=pa.array([p[1:] or None for p in places.values()], pa.list_(pa.int64())),
            )

    return arrow_map(docs, job, SUFFIX)


def _matrix(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Words of each row, filled up to REACH, and how many there are."""
    n = np.array([len(v) for v in column.to_pylist()], np.int64) // 4
    out = np.zeros((len(n), REACH), ">u4")
    flat = np.frombuffer(b"".join(column.to_pylist()), ">u4")
    out[np.arange(REACH)[None, :] < n[:, None]] = flat
    return out, n


def _equal_words(a: np.ndarray, b: np.ndarray, limit: np.ndarray) -> np.ndarray:
    differ = a != b
    first = np.where(differ.any(1), differ.argmax(1), REACH)
    return np.minimum(first, limit)


def compare(table: pa.Table, neighbours: int = NEIGHBOURS) -> dict[str, np.ndarray]:
    """What each suffix shares with those near it in sorted order.

    ``start`` to ``stop`` is what its matches of at least LEAST words cover together, all of which hold
    its position, and ``other`` the smallest document among them; ``stop`` is -1 without any. Then
    how far it agrees with any neighbour to the right (``on``) and to the left (``back``),
    and which windows of LEAST words its matches cover: bit k of ``seen`` is
    the window that begins k words before the position.
    """
    gram, doc, place = (table.column(c).to_numpy() for c in ("gram", "doc_id", "place"))
    (right, n_right), (left, n_left) = (_matrix(table.column(c).combine_chunks()) for c in ("right", "left"))
    rows = np.arange(len(doc))
    # the first row of another document after and before each row, and those some steps away
    turns = np.flatnonzero(doc[1:] != doc[:-1]) + 1
    after = np.append(turns, len(doc))[np.searchsorted(turns, rows, "right")]
    before = np.concatenate([[0], turns])[np.searchsorted(turns, rows, "right")] - 1
    far = np.iinfo(np.int64).max
    out = {name: np.full(len(doc), value) for name, value in (("start", far), ("stop", -1), ("other", far), ("on", 0), ("back", 0))}
    seen = np.zeros(len(doc), np.uint64)
    pairs = [(rows, after), (before, rows), *[(rows, rows + step) for step in range(1, neighbours + 1)]]
    for a, b in pairs:
        inside = (a >= 0) & (b < len(doc))
        a, b = a[inside], b[inside]
        apart = (gram[a] == gram[b]) & (doc[a] != doc[b])
        a, b = a[apart], b[apart]
        on = _equal_words(right[a], right[b], np.minimum(n_right[a], n_right[b]))
        back = _equal_words(left[a], left[b], np.minimum(n_left[a], n_left[b]))
        for row in (a, b):
            np.maximum.at(out["on"], row, on)
            np.maximum.at(out["back"], row, back)
        good = (on + back >= LEAST) & (on >= GRAM)
        a, b, on, back = a[good], b[good], on[good], back[good]
        covered = _window_bits(LEAST - on, back)
        for x, y in ((a, b), (b, a)):
            np.bitwise_or.at(seen, x, covered)
            np.minimum.at(out["start"], x, place[x] - back)
            np.maximum.at(out["stop"], x, place[x] + on)
            np.minimum.at(out["other"], x, doc[y])
    return {**out, "seen": signed(seen)}


def _window_bits(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Numbers with the bits low to high, those below WINDOW; none where low is above high."""
    low, high = np.maximum(low, 0), np.minimum(high, WINDOW - 1)
    one = np.uint64(1)
    upto = (one << (np.maximum(high, -1) + 1).astype(np.uint64)) - one
    below = (one << np.minimum(low, WINDOW).astype(np.uint64)) - one
    return upto & ~below


#: A suffix with what its neighbours share with it, or one near the end of its range, with its words and its place there.
OUTCOME = (
    "doc_id long, place long, more array<bigint>, start long, stop long, other long, on long, back long, seen long, "
    "gram long, right binary, left binary, part long, at long, outermost boolean"
)
KINDS = {"long": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_(), "array<bigint>": pa.list_(pa.int64())}
EDGE = ("gram", "right", "left", "doc_id", "place", "more", "part", "at", "outermost")
#: Rows that other ranges hand on stand before place 0 or from here on.
BEHIND = 1 << 62


def _filled(n: int, **columns) -> pa.RecordBatch:
    """A batch of OUTCOME; columns that are not given are null."""
    kinds = [field.rsplit(" ", 1) for field in OUTCOME.split(", ")]
    return batch_of(**{c: columns[c] if c in columns else pa.nulls(n, KINDS[kind]) for c, kind in kinds})


def _shared(table: pa.Table, own: np.ndarray | None = None) -> pa.RecordBatch:
    """OUTCOME rows of the suffixes (those of ``own``) that share words with a neighbour."""
    found = compare(table)
    some = np.flatnonzero((found["on"] > 0) if own is None else (found["on"] > 0) & own)
    bare = found["stop"][some] < 0
    columns = {k: pa.array(v[some], mask=bare) if k in ("start", "stop", "other") else v[some] for k, v in found.items()}
    named = {c: table.column(c).combine_chunks().take(pa.array(some)) for c in ("doc_id", "place", "more")}
    return _filled(len(some), **named, **columns)


def _turns(table: pa.Table) -> np.ndarray:
    """The rows that begin another gram or document."""
    gram, doc = table.column("gram").to_numpy(), table.column("doc_id").to_numpy()
    return np.flatnonzero((gram[1:] != gram[:-1]) | (doc[1:] != doc[:-1])) + 1


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What neighbours in a sorted range share, and the suffixes that lack neighbours in other ranges.

    A run is the suffixes of one document and gram. The first and the last run are unfinished, and
    NEIGHBOURS rows on either side. The outermost are what other ranges may need: these rows,
    the first one behind the first run, and the last one before the last run.
    """
    pending, at, head, turn = [], 0, None, -1
    for batch in batches:
        if not batch.num_rows:
            continue
        now = pa.Table.from_batches([batch])
        joint = pa.concat_tables([pending[-1].slice(pending[-1].num_rows - 1), now]) if pending else now
        pending.append(now)
        if not len(_turns(joint)):
            continue  # the last run goes on, and one document has nothing to compare
        both = pa.concat_tables(pending)
        yield _shared(both)
        if at == 0:
            turn = int(_turns(both)[0])
            head = both.slice(0, max(NEIGHBOURS, turn + 1))
        done = max(0, min(both.num_rows - NEIGHBOURS, int(_turns(both)[-1]) - 1))
        at += done
        pending = [both.slice(done)]
    if pending:
        part, tail = TaskContext.get().partitionId(), pa.concat_tables(pending)
        turns = _turns(tail)
        last = at + (int(turns[-1]) if len(turns) else 0)
        head = (head if head is not None else tail).slice(0, at)
        for rows, first in ((head, 0), (tail, at)):
            n = rows.num_rows
            place = np.arange(first, first + n)
            outermost = (place < NEIGHBOURS) | (place == turn) | (place >= at + tail.num_rows - NEIGHBOURS) | (place == last - 1)
            got = {c: rows.column(c).combine_chunks() for c in ("gram", "right", "left", "doc_id", "place", "more")}
            yield _filled(n, **got, part=np.full(n, part), at=place, outermost=outermost)


def _handed_on(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each range the rows of others that its ends lack, from the outermost rows of all ranges."""
    table = whole_partition(batches)
    if table is None:
        return
    part, n = table.column("part").to_numpy(), table.num_rows
    turns = _turns(table)
    begin = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
    for first, end in zip(begin, np.append(begin[1:], n), strict=True):
        run = np.searchsorted(turns, first, "right")
        before = {*range(max(0, first - NEIGHBOURS), first), int(turns[run - 1]) - 1 if run else -1} - {-1}
        run = np.searchsorted(turns, end - 1, "right")
        after = {*range(end, min(n, end + NEIGHBOURS)), int(turns[run]) if run < len(turns) else n} - {n}
        rows = np.array(sorted(before | after), np.int64)
        took = table.take(pa.array(rows))
        at = np.where(rows < first, rows - first, rows - end + BEHIND)
        own = {c: took.column(c).combine_chunks() for c in EDGE if c not in ("part", "at")}
        yield batch_of(**{c: {"part": np.full(len(rows), part[first]), "at": at}.get(c, own.get(c)) for c in EDGE})


def _ends(table: pa.Table) -> pa.Table:
    """What the unfinished suffixes of one range share with the rows handed on to it."""
    table = table.sort_by("at").combine_chunks()
    at = table.column("at").to_numpy()
    return pa.Table.from_batches([_shared(table, (at >= 0) & (at < BEHIND))])


def _compared(rows: DataFrame, order: list[str]) -> DataFrame:
    """What each suffix shares with its neighbours in one order of all suffixes; some have several rows."""
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    compared, _ = stage(placed.mapInArrow(_neighbours, OUTCOME), "matches")
    ends = compared.filter("part is not null").select(*EDGE)
    handed = ends.filter("outermost").repartition(1).sortWithinPartitions("part", "at").mapInArrow(_handed_on, ends.schema)
    ends = ends.unionByName(handed).groupBy("part").applyInArrow(_ends, OUTCOME)
    return compared.filter("part is null").unionByName(ends).drop("gram", "right", "left", "part", "at", "outermost")


def _unseen(each: DataFrame) -> DataFrame:
    """(key) of suffixes with a window that may be repeated and that no match covers.

    The best neighbours to both sides bound what any other document can share with a suffix.
    """
    ones = lambda n: F.expr(f"shiftleft(1L, cast({n} as int)) - 1")
    may = ones(f"least(back, {WINDOW - 1}) + 1").bitwiseAND(F.bitwise_not(ones(f"least({LEAST} - on, {WINDOW})")))
    left = may.bitwiseAND(F.bitwise_not(F.col("seen")))
    return each.filter(left != 0).select(F.xxhash64("doc_id", "place").alias("key"))


def _window_hashes(right: pa.Array, left: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, k and hash of each window of LEAST words that begins k words before a position."""
    (ahead, n_right), (behind, n_left) = _matrix(right), _matrix(left)
    line = np.concatenate([behind[:, : WINDOW - 1][:, ::-1], ahead], axis=1).astype(np.uint64)
    power = np.cumprod(np.full(LEAST, 0x9E3779B97F4A7C15, np.uint64))
    line = mix(line)
    row, k, value = [], [], []
    for back in range(WINDOW):
        at = np.flatnonzero((n_left >= back) & (n_right >= LEAST - back))
        first = WINDOW - 1 - back
        row.append(at)
        k.append(np.full(len(at), back))
        value.append(mix((line[at, first : first + LEAST] * power).sum(1, dtype=np.uint64)))
    return np.concatenate(row), np.concatenate(k), np.concatenate(value)


MATCH = ("doc_id", "place", "more", "start", "stop", "other")


def _exact(rows: DataFrame, each: DataFrame) -> DataFrame:
    """MATCH rows: the windows, held by two documents, of suffixes with unseen ones.

    Windows of such suffixes are looked for in all suffixes: a window that two documents share
    has a selected position of one gram in both.
    """
    unseen, _ = stage(_unseen(each), "unseen")
    if unseen.isEmpty():
        return each.select(*MATCH).limit(0)
    keyed = rows.select("doc_id", "place", "more", "right", "left", F.xxhash64("doc_id", "place").alias("key"))

    def windows(chosen: Filter, of_key: bool):
        def job(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            if of_key:
                batch = batch.filter(pa.array(chosen.has(batch.column("key").to_numpy())))
            for first in range(0, batch.num_rows, 4096):
                part = batch.slice(first, 4096)
                row, k, value = _window_hashes(part.column("right"), part.column("left"))
                if not of_key:
                    keep = chosen.has(signed(value))
                    row, k, value = row[keep], k[keep], value[keep]
                named = {c: take_column(part, c).take(pa.array(row)) for c in ("doc_id", "place", "more")}
                yield batch_of(window=signed(value), **named, start=named["place"].to_numpy() - k)

        return arrow_map(keyed, job, "window long, doc_id long, place long, more array<bigint>, start long")

    asked, _ = stage(windows(Filter.of(unseen), True).distinct(), "asked")
    held = windows(Filter.of(asked.select("window")), False).groupBy("window")
    held = held.agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).filter("low < high")
    other = F.when(F.col("doc_id") == F.col("low"), F.col("high")).otherwise(F.col("low"))
    return (
        asked.join(held, "window").withColumns({"stop": F.col("start") + LEAST, "other": other}).select(*MATCH)
    )


def repeated_passages(docs: DataFrame) -> DataFrame:
    """doc_id, start, stop, n_words, other: the repeated passages of each document."""
    text = docs.filter("doc_id is not null").select("doc_id", "text")
    grams = arrow_map(text, _grams, "gram long, doc_id long")
    shared = grams.groupBy("gram").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
    shared, _ = stage(shared.filter("low < high").select("gram"), "grams")
    rows, _ = stage(suffixes(text, Filter.of(shared)), "suffixes")
    onward = _compared(rows, ["gram", "right", "left", "doc_id", "place"])
    backward = _compared(rows, ["gram", "left", "right", "doc_id", "place"])
    each, _ = stage(
        onward.unionByName(backward).groupBy("doc_id", "place", "more")
        .agg(F.min("start").alias("start"), F.max("stop").alias("stop"), F.min("other").alias("other"),
             F.max("on").alias("on"), F.max("back").alias("back"), F.bit_or("seen").alias("seen")),
        "extents",
    )
    matches = each.filter("start is not null").select(*MATCH).unionByName(_exact(rows, each))
    # the same match at all positions of a row
    further = F.transform(F.coalesce("more", F.array().cast("array<bigint>")), lambda p: p - F.col("place"))
    steps = F.explode(F.concat(F.array(F.lit(0).cast("long")), further))
    matches = matches.select("doc_id", "start", "stop", "other", steps.alias("step"))
    spans = matches.groupBy("doc_id", (F.col("start") + F.col("step")).alias("start"), (F.col("stop") + F.col("step")).alias("stop"))
    spans = spans.agg(F.min("other").alias("other"))
    by_start = Window.partitionBy("doc_id").orderBy("start", "stop")
    reached = F.max("stop").over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    apart = (F.coalesce(reached, F.lit(-1)) < F.col("start")).cast("int")
    return (
        spans.withColumn("apart", apart)
        .withColumn("span", F.sum("apart").over(by_start))
        .groupBy("doc_id", "span")
        .agg(F.min("start").alias("start"), F.max("stop").alias("stop"), F.min("other").alias("other"))
        .select("doc_id", "start", "stop", (F.col("stop") - F.col("start")).alias("n_words"), "other")
    )
