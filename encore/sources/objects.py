"""The JSON objects in text files, in time linear in the text, from ranges of large files.

Files are read line by line, so Spark splits a large one at any line into ranges that many
tasks read. Whether a range begins inside an object, and how deep, is known from all ranges
before it: a range turns the depth of braces ``d`` at its start into ``max(d + sum, sum - least)``,
where ``least`` is its lowest running sum. A first pass, only over files that are split, finds
these two numbers; running sums and minima over the ranges of a file then give each depth.

Braces count outside of strings only. A string ends on its line, as in JSON; a quote that nothing
closes is text, and so are all quotes after it on that line. An object is all from an opening
brace outside of objects to the brace that closes it, over any number of lines. Other text that is
not blank is a piece of its own, line by line, and so is an object that its file, or in ``LINES``
its line, does not finish: neither parses, so each is a bad record.

Each piece comes with its place: the file, the byte at which the range it was read with begins
(0 in files that are not split), and the number of its first line within that range.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from encore.scratch import discard, stage

LINES = "lines"  # no object goes over a line's end
DOCUMENTS = "documents"  # objects may be pretty-printed over many lines

PLACE = ["file", "from_byte", "line"]
STEP = 4 << 20  # bytes of whole lines that are looked at together

_MARKS = np.zeros(256, bool)
_MARKS[[ord(c) for c in '{}"\\']] = True
_BLANK = b" \t\n\x0b\x0c\r"
_STRING = re.compile(rb'"[^"\\]*+(?:\\.[^"\\]*+)*+"', re.DOTALL)
_BRACE_OR_QUOTE = re.compile(rb'[{}"]')


def _braces_of(line: bytes) -> list[int]:
    """Places of the braces outside of strings, for any line."""
    found, at, strings = [], 0, True
    while piece := _BRACE_OR_QUOTE.search(line, at):
        at = piece.end()
        if piece.group() != b'"':
            found.append(piece.start())
        elif strings:
            string = _STRING.match(line, piece.start())
            strings = string is not None
            at = string.end() if string else at
    return found


def braces(text: np.ndarray, line_end: np.ndarray) -> np.ndarray:
    """Places of the braces outside of strings; line k ends at ``line_end[k]``, all lines back to back."""
    mark = np.flatnonzero(_MARKS[text])
    kind = text[mark]
    line = np.searchsorted(line_end, mark)
    slash = mark[kind == ord("\\")]
    escaped = np.zeros(len(mark), bool)
    if len(slash):
        head = np.flatnonzero(np.diff(slash, prepend=-2) != 1)
        size = np.diff(np.append(head, len(slash)))
        after = (slash[head] + size)[size % 2 == 1]
        at = np.minimum(np.searchsorted(after, mark), max(len(after) - 1, 0))
        escaped = after[at] == mark if len(after) else escaped
    quote = (kind == ord('"')) & ~escaped
    quotes = np.cumsum(quote)
    first = np.searchsorted(line, np.arange(len(line_end) + 1))
    before = np.concatenate([[0], quotes])[first]
    inside = (quotes - before[line]) % 2 == 1
    brace = (kind == ord("{")) | (kind == ord("}"))
    # Open strings and backslashes outside of strings are no JSON; such lines are gone through one by one.
    odd = np.diff(before) % 2 == 1
    odd[line[(kind == ord("\\")) & ~inside]] = True
    plain = mark[brace & ~inside & ~odd[line]]
    if not odd.any():
        return plain
    begin = np.concatenate([[0], line_end[:-1] + 1])
    slow = [begin[k] + np.array(_braces_of(text[begin[k] : line_end[k]].tobytes()), np.int64) for k in np.flatnonzero(odd)]
    return np.sort(np.concatenate([plain, *slow]))


def depths(step: np.ndarray, group: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Depth after each brace; ``step`` is 1 or -1, groups begin at ``start`` and never go below 0."""
    if not len(step):
        return step
    total = np.cumsum(step)
    head = np.searchsorted(group, np.arange(len(start)))
    free = total - np.concatenate([[0], total])[head][group] + start[group]
    # Each group far below the one before, so that a running minimum is that of the group.
    shift = group * (2 * len(step) + 2 * int(start.max(initial=0)) + 2)
    return free - np.minimum(np.minimum.accumulate(free - shift) + shift, 0)


@dataclass
class _Part:
    """Whole lines of a batch back to back, with a newline after each, and the runs of one range."""

    text: np.ndarray
    line_end: np.ndarray
    file: list[str | None]
    from_byte: np.ndarray
    to_byte: np.ndarray
    size: np.ndarray
    run: np.ndarray  # of each line
    head: np.ndarray  # first line of each run


def _parts(batch: pa.RecordBatch) -> Iterator[_Part]:
    value, file = batch.column(0).cast(pa.large_string()), batch.column(1)
    value = value.fill_null("")
    offsets = np.frombuffer(value.buffers()[1], np.int64)[value.offset : value.offset + len(value) + 1]
    data = value.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    begin, length, size = (c.fill_null(0).to_numpy(zero_copy_only=False) for c in batch.columns[2:5])
    name = file.dictionary_encode()
    code = name.indices.fill_null(-1).to_numpy(zero_copy_only=False)
    new = np.ones(len(value), bool)
    new[1:] = (code[1:] != code[:-1]) | (begin[1:] != begin[:-1])
    at = 0
    while at < len(value):
        to = max(int(np.searchsorted(offsets, offsets[at] + STEP, "right")) - 1, at + 1)
        ends = offsets[at + 1 : to + 1] - offsets[at]
        fresh = new[at:to].copy()
        fresh[0] = True
        head = np.flatnonzero(fresh)
        yield _Part(
            np.insert(data[offsets[at] : offsets[to]], ends, 10), ends + np.arange(to - at),
            [file[int(at + h)].as_py() for h in head], begin[at:to][head], (begin + length)[at:to][head],
            size[at:to][head], np.cumsum(fresh) - 1, head,
        )
        at = to


@dataclass
class _Open:
    """What is left of a range at the end of a part: its unfinished object and how deep it is."""

    file: str | None
    from_byte: int
    last: bool  # the range ends the file
    owner: int  # the range in which the unfinished object begins
    depth: int = 0
    lines: int = 0
    text: list[bytes] = field(default_factory=list)
    line: int = 0  # where the unfinished object begins

    @property
    def inner(self) -> bool:
        """Began inside an object and has not come out yet."""
        return self.owner != self.from_byte


class _Rows:
    """Pieces as columns: whole ones with their place, or fragments of objects over several ranges."""

    def __init__(self, fragments: bool):
        self.fragments = fragments
        self.found: list[tuple] = []

    def add(self, value: bytes, of: _Open, line: int, fragment: bool) -> None:
        if fragment == self.fragments and (fragment or value):
            self.found.append((value, of.file, of.from_byte, line, of.owner))

    def batches(self) -> Iterator[pa.RecordBatch]:
        if not self.found:
            return
        value, *place = zip(*self.found, strict=True)
        raw = pa.array(value, pa.binary())
        # as it is: text that is not UTF-8 is for the parser to refuse
        text = pa.StringArray.from_buffers(len(raw), raw.buffers()[1], raw.buffers()[2])
        columns = [text, *(pa.array(c, k) for c, k in zip(place, [pa.string()] + [pa.int64()] * 3, strict=True))]
        names = ["value", *PLACE, "owner"]
        shown = len(names) if self.fragments else len(names) - 1
        yield pa.RecordBatch.from_arrays(columns[:shown], names=names[:shown])


def _finish(of: _Open | None, rows: _Rows) -> None:
    """The unfinished object at the end of a range, whole only if nothing of it is elsewhere."""
    if of is not None and of.text:
        apart = of.inner or not of.last
        text = b"".join(of.text)
        rows.add(text if apart else text.strip(_BLANK), of, of.line, apart)


@dataclass(frozen=True)
class _Cutter:
    """Cuts the lines of a task's ranges, which come one after the other in their order.

    ``starts`` has depth and owner of the ranges that begin inside an object, which lie at
    multiples of ``step`` bytes. Yields whole pieces, or else the fragments.
    """

    by_line: bool
    starts: dict[tuple[str, int], tuple[int, int]] = field(default_factory=dict)
    step: int = 0
    fragments: bool = False

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: _Open | None = None
        for batch in batches:
            for part in _parts(batch):
                rows = _Rows(self.fragments)
                runs = [self._run(part, k) for k in range(len(part.file))]
                if now is not None and (now.file, now.from_byte) == (runs[0].file, runs[0].from_byte):
                    runs[0] = now
                else:
                    _finish(now, rows)
                _cut(part, runs, rows, self.by_line)
                now = runs[-1]
                yield from rows.batches()
        rows = _Rows(self.fragments)
        _finish(now, rows)
        yield from rows.batches()

    def _run(self, part: _Part, k: int) -> _Open:
        file, begin = part.file[k], int(part.from_byte[k])
        if self.step and begin % self.step:
            raise ValueError(f"{file} is not split as it was before, at byte {begin}")
        depth, owner = self.starts.get((file, begin), (0, begin))
        return _Open(file, begin, self.by_line or bool(part.to_byte[k] >= part.size[k]), owner, depth)


def _cut(part: _Part, runs: list[_Open], rows: _Rows, by_line: bool) -> None:
    """Adds the finished pieces of a part to ``rows`` and what is unfinished to its run."""
    line_end, count = part.line_end, len(part.line_end)
    place = braces(part.text, line_end)
    opens = part.text[place] == ord("{")
    line_of = np.searchsorted(line_end, place)
    group = line_of if by_line else part.run[line_of]
    start = np.zeros(count, np.int64) if by_line else np.array([r.depth for r in runs], np.int64)
    depth = depths(np.where(opens, 1, -1), group, start)
    # depth at the end of each line: that of the last brace of its group so far
    last = np.searchsorted(place, line_end) - 1
    own = np.arange(count) if by_line else part.run
    known = last >= 0
    known[known] = group[last[known]] == own[known]
    at_end = start[own].copy()
    at_end[known] = depth[last[known]]
    closed = np.ones(count, bool) if by_line else at_end == 0
    closing = np.append(part.head[1:] - 1, count - 1)  # last line of each run
    cuts = np.concatenate([place[~opens & (depth == 0)] + 1, place[opens & (depth == 1)], line_end[closed] + 1, line_end[closing] + 1])
    cuts = np.unique(np.concatenate([[0], cuts]))
    line = np.searchsorted(line_end, cuts[:-1])
    run = part.run[line]
    begins_run = np.ones(len(run), bool)
    begins_run[1:] = run[1:] != run[:-1]
    ends_run = np.append(begins_run[1:], True)
    raw = part.text.tobytes()
    left_open = ends_run & (at_end[closing][run] > 0) & (not by_line)
    special = begins_run | left_open
    for k, (a, b, l, r) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist(), line.tolist(), run.tolist(), strict=True)):
        of = runs[r]
        number = of.lines + l - int(part.head[r]) + 1
        if not special[k]:
            rows.add(raw[a:b].strip(_BLANK), of, number, False)
            continue
        if begins_run[k] and of.text:  # goes on with an object of the part before
            number = of.line
        of.text.append(raw[a:b])
        of.line = number
        if left_open[k]:
            if ends_run[k] and r < len(runs) - 1:
                _finish(of, rows)
            continue
        text = b"".join(of.text)
        rows.add(text if of.inner else text.strip(_BLANK), of, number, of.inner)
        of.owner, of.text = of.from_byte, []
    for r, of in enumerate(runs):
        of.lines += int(closing[r] - part.head[r]) + 1
        of.depth = int(at_end[closing[r]])


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(file, from_byte, length, size, total, least): the sums of braces of each range of a task."""
    found: dict[tuple[str | None, int], list[int]] = {}
    for batch in batches:
        for part in _parts(batch):
            place = braces(part.text, part.line_end)
            step = np.where(part.text[place] == ord("{"), 1, -1)
            run = part.run[np.searchsorted(part.line_end, place)]
            edge = np.searchsorted(run, np.arange(len(part.file) + 1))
            for k, key in enumerate(zip(part.file, part.from_byte.tolist(), strict=True)):
                own = found.setdefault(key, [int(part.to_byte[k]) - key[1], 0, 0])
                running = own[1] + np.cumsum(step[edge[k] : edge[k + 1]])
                if len(running):
                    own[1:] = int(running[-1]), min(own[2], int(running.min()))
    rows = [(f, b, *numbers) for (f, b), numbers in found.items()]
    columns = list(zip(*rows, strict=True)) if rows else [()] * 5
    kinds = [pa.string()] + [pa.int64()] * 4
    yield pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["file", "from_byte", "length", "total", "least"]
    )


SUMS = "file string, from_byte long, length long, total long, least long"


def range_depths(sums: DataFrame) -> DataFrame:
    """(file, from_byte, depth, owner) of the ranges that begin inside an object.

    ``owner`` is the range in which the object begins. A file has one row here per range.
    """
    so_far = Window.partitionBy("file").orderBy("from_byte").rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy("file").orderBy("from_byte").rowsBetween(Window.unboundedPreceding, -1)
    in_order = Window.partitionBy("file").orderBy("from_byte")
    summed = sums.withColumn("after", F.sum("total").over(so_far))
    lowest = F.min(F.col("after") - F.col("total") + F.col("least")).over(so_far)
    ended = summed.withColumn("end", F.col("after") - F.least(F.lit(0), lowest))
    placed = ended.withColumn("depth", F.coalesce(F.lag("end").over(in_order), F.lit(0)))
    comes_out = F.col("depth") + F.col("least") <= 0
    owners = placed.withColumn("owner", F.last(F.when(comes_out, F.col("from_byte")), ignorenulls=True).over(earlier))
    return owners.where("depth > 0").select("file", "from_byte", "depth", "owner")


def _lines(spark: SparkSession, path: str) -> DataFrame:
    read = spark.read.option("recursiveFileLookup", "true").text(path)
    names = {"file": "file_path", "from_byte": "file_block_start", "_length": "file_block_length", "_size": "file_size"}
    return read.select("value", *[F.col(f"_metadata.{source}").alias(name) for name, source in names.items()])


PIECES = "value string, file string, from_byte long, line long"


def objects(spark: SparkSession, path: str, layout: str) -> DataFrame:
    """(value, file, from_byte, line): the objects, and the text beside them, of all files under ``path``."""
    if layout not in (LINES, DOCUMENTS):
        raise ValueError(f"unknown layout of files {layout!r}")
    lines = _lines(spark, path)
    if layout == LINES or not _may_split(spark, path):
        return lines.mapInArrow(_Cutter(layout == LINES), PIECES)
    split = lines.where("_length < _size")
    sums, staged = stage(split.mapInArrow(_sums, SUMS), "ranges")
    step = sums.agg(F.max("length")).first()[0] or 0
    # One row per range that begins inside an object: fewer than the splits that Spark's driver lists.
    starts = {(r["file"], r["from_byte"]): (r["depth"], r["owner"]) for r in range_depths(sums).collect()}
    discard(spark, staged)
    whole = lines.mapInArrow(_Cutter(False, starts, step), PIECES)
    if not starts:
        return whole
    parts = split.mapInArrow(_Cutter(False, starts, step, fragments=True), f"{PIECES}, owner long")
    joined = (
        parts.groupBy("file", "owner")
        .agg(F.sort_array(F.collect_list(F.struct("from_byte", "line", "value"))).alias("_parts"))
        .select(
            F.regexp_replace(F.concat_ws("", F.col("_parts.value")), r"^\s+|\s+$", "").alias("value"),
            "file", F.col("owner").alias("from_byte"), F.col("_parts")[0]["line"].alias("line"),
        )
    )
    return whole.unionByName(joined)


def _may_split(spark: SparkSession, path: str) -> bool:
    """Whether a file is so large that Spark may read it in several ranges; looks at sizes only."""
    conf = spark._jsparkSession.sessionState().conf()
    least = min(conf.filesOpenCostInBytes(), conf.filesMaxPartitionBytes())
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return not files.select("length").where(F.col("length") > least).isEmpty()


def objects_of(texts: DataFrame) -> DataFrame:
    """The objects in column ``value`` of any rows, and the text beside them; none goes over a row's end."""
    nowhere = [F.lit(None).cast("string").alias("file"), *[F.lit(0).cast("long").alias(c) for c in ("_from", "_length", "_size")]]
    return texts.select("value", *nowhere).mapInArrow(_Cutter(True), PIECES).select("value")
