"""Line dedup against plain Python, and undoing of inserts."""

import random

import numpy as np

import pytest

from encore.llm.line_dedup import CuckooFilter, LineIndex, dedup_lines, drops
from encore.llm.textarrays import mix

LOWER = {i: i + 32 for i in range(65, 91)}
BLANKS = " \t\n\x0b\x0c\r"


def brute(rows):
    holders = {}
    key = lambda line: line.strip(BLANKS).translate(LOWER)
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 10 and doc_id is not None:
                holders.setdefault(key(line), set()).add(doc_id)
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        gone = [doc_id is not None and len(holders.get(key(x), ())) > 1 and min(holders[key(x)]) != doc_id for x in lines]
        out.append((doc_id, len(lines), sum(gone), "\n".join(x for x, g in zip(lines, gone) if not g)))
    return sorted(out, key=str)


def found(df):
    got = [(r.doc_id, r.line_count, r.lines_dropped, r.text or "") for r in df.collect()]
    return sorted(got, key=str)


def corpus(seed, n=120):
    dice = random.Random(seed)
    pool = [f"line number {k} Ünï" for k in range(25)] + ["short", "", "  ", "ninechars", "tenchars12", "éééééééééé"]
    rows = []
    for k in range(n):
        lines = [dice.choice(pool) if dice.random() < 0.6 else f"own {k} {dice.random()}" for _ in range(dice.randint(0, 9))]
        lines = [dice.choice(["{}", " {}\t", "{}\r"]).format(x.upper() if dice.random() < 0.2 else x) for x in lines]
        rows.append((n - k, "\n".join(lines)))
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(3)


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_plain_python(spark, seed):
    rows = corpus(seed)
    assert found(dedup_lines(frame(spark, rows))) == brute(rows)


def test_odd_rows(spark):
    rows = [
        (1, None), (2, ""), (3, "\n"), (None, "a line of some length"), (4, "a line of some length"),
        (4, "a line of some length"), (5, "A LINE of some length\nx\n"), (6, "a line of some length" * 9000), (7, "a line of some length" * 9000),
    ]
    docs = spark.createDataFrame([(*r, 1, "z") for r in rows], "doc_id long, text string, line_count int, lost_keys string")
    got = dedup_lines(docs)
    assert found(got) == brute(rows)
    assert got.columns == ["doc_id", "text", "lost_keys", "line_count", "lines_dropped"]
    assert [r.text for r in got.filter("doc_id = 1").collect()] == [None]
    assert dedup_lines(docs.limit(0)).collect() == []


def test_inserts_and_deletions_are_reversible(spark):
    rows = corpus(7)
    first, later = frame(spark, rows[:80]), frame(spark, rows[80:])
    index = LineIndex.of(first, shards=4)
    before = found(index.resolve(first))
    grown, shared = index.insert(later)
    assert found(grown.resolve(frame(spark, rows))) == brute(rows)
    keys = lambda df: {(r.high, r.low) for r in df.select("high", "low").collect()}
    assert keys(shared) == keys(index.references) & keys(LineIndex.of(later, shards=4).references)
    back = grown.delete(later.select("doc_id"))
    assert found(back.resolve(first)) == before == brute(rows[:80])
    assert sorted(back.references.collect()) == sorted(index.references.collect())
    # the filters still know all keys that are left, and few others
    known = back.references
    assert back.perhaps_known(known).count() == known.count()
    gone = grown.references.join(known, ["high", "low"], "left_anti").select(*known.columns)
    assert back.perhaps_known(gone).count() <= 2


def test_deleting_the_keeper_hands_the_line_on(spark):
    rows = [(1, "the same long line"), (2, "the same long line"), (3, "the same long line")]
    index = LineIndex.of(frame(spark, rows), shards=2)
    rest = index.delete(spark.createDataFrame([(1,)], "doc_id long"))
    assert [r[2] for r in found(rest.resolve(frame(spark, rows[1:])))] == [0, 1]


def test_a_full_shard_keeps_few_bytes_a_key():
    """Keys of one shard of 256 are alike in their low bits, and still spread over all buckets."""
    keys = mix(np.arange(1, 2_000_000, dtype=np.uint64))
    own = keys[keys % np.uint64(256) == 7][:6500]
    box = CuckooFilter.for_keys(len(own))
    assert box.insert(own) and box.tests(own).all() and box.table.nbytes / len(own) < 3
    others = keys[keys % np.uint64(256) == 8][:6500]
    assert box.tests(others).mean() < 0.01


def test_the_answer_comes_from_keys_the_filters_know(spark):
    rows = [(k, f"a line that only {k} has\nthe line that all of them have\nshared by two {k // 2}") for k in range(300)]
    index = LineIndex.of(frame(spark, rows))
    assert index.references.select("high").distinct().count() == 300 + 1 + 150
    perhaps = index.perhaps.distinct().count()
    assert 151 <= perhaps <= 160, "repeated keys, and few that a filter takes for known"
    got = {r.doc_id: r.lines_dropped for r in index.resolve(frame(spark, rows)).collect()}
    assert got == {k: (k > 0) + (k % 2) for k in range(300)}
    none = LineIndex(index.spark, index.references, index.filters, index.shards, perhaps=index.perhaps.limit(0))
    assert {r.lines_dropped for r in none.resolve(frame(spark, rows)).collect()} == {0}


def test_keys_repeat_across_chunks_and_batches(spark, monkeypatch):
    monkeypatch.setattr("encore.llm.line_dedup.CHUNK", 8)
    monkeypatch.setattr("encore.llm.line_dedup.SHARD_KEYS", 50)
    rows = corpus(11, 200)
    assert found(dedup_lines(frame(spark, rows))) == brute(rows)


def test_many_rows_of_one_document_make_no_long_list(spark):
    """A doc_id with a third of all rows: each of its texts is sent its own lost keys only, equal ones once."""
    rows = [(9, f"shared line number {k % 60}\nown line of text {k % 60}") for k in range(300)]
    rows += [(k + 10, f"own words of {k}\nshared line number {k % 60}") for k in range(300)] + [(1, f"shared line number {k}") for k in range(60)]
    docs = frame(spark, rows)
    assert found(dedup_lines(docs)) == brute(rows)
    lost = drops(LineIndex.of(docs).references)
    assert {len(r.lost_keys) for r in lost.collect()} == {1}
    assert lost.filter("doc_id = 9").count() == 60
