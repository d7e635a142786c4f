"""Words, shingles, filters and components against plain Python."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from encore.llm.components import components
from encore.llm.line_dedup import CuckooFilter
from encore.llm.membership import Filter
from encore.llm.textarrays import distinct, hashes, shingles, slices, words

TEXTS = ["", None, "one", " a  b\tc\nd\x0be\x0cf\r", "Ä ä ÀB ab", "x" * 9000, "lone\n", "a b c d e", "a b c d", "w " * 300]


@pytest.mark.parametrize("step", [1, 40, 1 << 20])
def test_words(step):
    seen = 0
    for s in slices(pa.array(TEXTS), step):
        w = words(s)
        for r in range(len(s)):
            text = TEXTS[s.first + r] or ""
            found = [s.data[a:b].tobytes().decode() for a, b in zip(w.start[w.row == r], w.end[w.row == r])]
            assert found == re.findall(r"[^\x20\x09-\x0D]+", text)
            seen += 1
    assert seen == len(TEXTS)


def test_hashes_depend_on_the_bytes_alone():
    [s] = slices(pa.array(["ab abc ab", "abc b", "ab"]))
    w = words(s)
    by_word = {}
    for a, b, h in zip(w.start, w.end, w.hash):
        by_word.setdefault(s.data[a:b].tobytes(), set()).add(int(h))
    assert all(len(v) == 1 for v in by_word.values()) and len(set.union(*by_word.values())) == 3
    assert (hashes(s.data, w.start, w.end, step=2) == w.hash).all()


def test_shingles():
    [s] = slices(pa.array(TEXTS))
    values, first = shingles(words(s))
    counts = [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for t in TEXTS]
    assert np.diff(first).tolist() == [n - 4 if n >= 5 else int(n > 0) for n in counts]
    same = values[first[9] : first[10]]
    assert len(set(same.tolist())) == 1
    assert values[first[7]] != values[first[8]]


def test_sliced_columns():
    column = pa.array(["skip", "a b", "c"]).slice(1)
    [s] = slices(column)
    assert s.data.tobytes() == b"a bc" and s.offsets.tolist() == [0, 3, 4]


def test_distinct():
    assert distinct(np.array([3, 1, 3, 2, 1])).tolist() == [1, 2, 3]
    assert len(distinct(np.zeros(0))) == 0


def test_bloom_filter(spark):
    keys = spark.range(5000).selectExpr("xxhash64(id) as k")
    held = Filter.of(keys)
    known = np.array([r.k for r in keys.collect()])
    assert held.has(known).all()
    others = np.array([r.k for r in spark.range(5000, 15000).selectExpr("xxhash64(id) as k").collect()])
    assert held.has(others).mean() < 0.05
    assert not Filter.of(keys.limit(0)).has(known).any()


def test_cuckoo_filter():
    dice = np.random.default_rng(1)
    keys = dice.integers(1 << 63, size=20_000, dtype=np.uint64)
    box = CuckooFilter.for_keys(len(keys))
    assert box.insert(keys[:10_000]) and box.insert(keys[10_000:])
    assert box.tests(keys).all()
    assert box.tests(dice.integers(1 << 63, size=50_000, dtype=np.uint64)).mean() < 0.002
    box.delete(keys[:5_000])
    assert box.tests(keys[5_000:]).all()
    assert box.tests(keys[:5_000]).mean() < 0.01
    small = CuckooFilter.for_keys(8)
    assert not small.insert(keys)


@pytest.mark.parametrize("local", [1_000_000, 50])
def test_components(spark, monkeypatch, local):
    monkeypatch.setattr("encore.llm.components.LOCAL", local)
    dice = random.Random(3)
    edges = [(i, i + 1) for i in range(100, 160)]  # a long path
    edges += [(500, n) for n in range(501, 700)]  # a star
    edges += [(dice.randrange(1000, 1400), dice.randrange(1000, 1400)) for _ in range(150)] + [(7, 7)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    found = components(spark.createDataFrame(edges, "a long, b long"))
    assert {r.node: r.component for r in found.collect()} == {n: find(n) for n in list(parent) if n != 7}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
