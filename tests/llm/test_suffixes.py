"""Repeated passages against all windows."""

import random
import re

import pytest

from encore.llm.suffixes import repeated_passages

LOWER = {i: i + 32 for i in range(65, 91)}


def brute(rows, least=50):
    texts = [(d, re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER))) for d, t in rows if d is not None]
    holders = {}
    for d, w in texts:
        for i in range(len(w) - least + 1):
            holders.setdefault(tuple(w[i : i + least]), set()).add(d)
    out = set()
    for d, w in texts:
        spans = []
        for i in range(len(w) - least + 1):
            if len(holders[tuple(w[i : i + least])]) > 1:
                if spans and i <= spans[-1][1]:
                    spans[-1][1] = i + least
                else:
                    spans.append([i, i + least])
        out |= {(d, a, b) for a, b in spans}
    return out


def corpus(seed, n=80):
    dice = random.Random(seed)
    words = lambda k: ["".join(dice.choice("abcdefgh") for _ in range(3)) for _ in range(k)]
    passages = [words(k) for k in (49, 50, 51, 70, 200, 400)]
    rows = []
    for k in range(n):
        w = words(dice.randint(0, 90))
        for _ in range(dice.randint(0, 2)):
            w += dice.choice(passages) + words(dice.randint(0, 30))
        if dice.random() < 0.1:
            w += ["same"] * dice.randint(10, 120)
        rows.append((k, dice.choice([" ", "\n"]).join(w)))
    return rows + [(n + k, rows[dice.randrange(n)][1].upper()) for k in range(6)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equals_all_windows(spark, seed):
    rows = corpus(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = repeated_passages(docs).collect()
    assert {(r.doc_id, r.start, r.stop) for r in found} == brute(rows)
    for r in found:
        assert r.n_words == r.stop - r.start >= 50 and r.other != r.doc_id


def test_words_that_go_on_repeating(spark):
    """Two documents share a run of one word, with and without shared words behind it."""
    own = lambda d, k: [f"{d}x{j}" for j in range(k)]
    tail = [f"t{j}" for j in range(45)]
    rows = [
        (1, own("a", 9) + ["="] * 120 + own("b", 9)), (2, own("c", 5) + ["="] * 120 + own("d", 5)),
        (3, own("e", 7) + ["0"] * 70 + tail + own("f", 7)), (4, own("g", 3) + ["0"] * 90 + tail + own("h", 3)),
        (5, ["-"] * 50 + own("i", 3)), (6, own("j", 3) + ["-"] * 131),
    ]
    rows = [(d, " ".join(w)) for d, w in rows]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert {(r.doc_id, r.start, r.stop) for r in repeated_passages(docs).collect()} == brute(rows)


def test_partner_that_is_best_on_neither_side(spark):
    """Many documents share more to the right, many more to the left, one holds a whole passage."""
    dice = random.Random(56)  # the only selected position of the passage is where y begins
    words = lambda k: [f"v{dice.random()}" for _ in range(k)]
    w, x, y, z = (words(k) for k in (5, 25, 30, 10))
    rows = [(0, words(9) + w + x + y + z + words(9)), (1, words(9) + x + y + words(9))]
    rows += [(k, words(9) + y + z + words(9)) for k in range(2, 40)]
    rows += [(k, words(9) + w + x + y[:15] + words(9)) for k in range(40, 80)]
    dice.shuffle(rows)
    rows = [(d, " ".join(t)) for d, t in rows]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert {(r.doc_id, r.start, r.stop) for r in repeated_passages(docs).collect()} == brute(rows)


def test_one_document_repeats_a_passage(spark):
    """Its suffixes, some alike and some not, fill sorted ranges that others have to look beyond."""
    dice = random.Random(7)
    words = lambda k: [f"v{dice.random()}" for _ in range(k)]
    passage, start = words(60), words(14)
    rows = [
        (1, words(5) + passage * 300), (2, words(5) + passage + words(7)),
        (3, sum((start + words(45) for _ in range(400)), [])), (4, words(3) + start + words(60)),
        (5, sum((passage + words(9) for _ in range(200)), [])),
    ]
    rows += [(10 + k, words(30) + rows[2][1][59 * k : 59 * k + 70 + k % 3]) for k in range(0, 400, 37)]
    rows = [(d, " ".join(t)) for d, t in rows]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    try:
        for partitions in (3, 97):  # without joining small ranges
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            spark.conf.set("spark.sql.adaptive.enabled", False)
            assert {(r.doc_id, r.start, r.stop) for r in repeated_passages(docs).collect()} == brute(rows)
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)


def test_one_passage_in_most_documents(spark):
    dice = random.Random(5)
    passage = [f"p{k}" for k in range(60)]
    rows = []
    for k in range(300):
        own = [f"o{dice.random()}" for _ in range(20)]
        rows.append((k, " ".join(own + (passage if k % 3 else []) + own[::-1])))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = {(r.doc_id, r.start, r.stop) for r in repeated_passages(docs).collect()}
    assert got == {(k, 20, 80) for k in range(300) if k % 3}


def test_odd_rows(spark):
    long = " ".join(f"w{k % 9973}" for k in range(40000))
    rows = [(1, None), (2, ""), (3, long), (3, long), (None, long), (4, "x " + long), (5, "short text")]
    docs = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, start int")
    got = sorted((r.doc_id, r.start, r.stop, r.other) for r in repeated_passages(docs).collect())
    assert got == [(3, 0, 40000, 4), (4, 1, 40001, 3)]
    assert repeated_passages(docs.filter("doc_id = 3")).collect() == []
    assert repeated_passages(docs.limit(0)).collect() == []
