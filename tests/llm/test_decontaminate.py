"""Benchmark decontamination against all pairs."""

import random
import re

import pytest

from encore.llm.decontaminate import Items, item_blocks, matches, without_contaminated

LOWER = {i: i + 32 for i in range(65, 91)}


def shingle_set(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(docs, items):
    out = []
    for d, t in docs:
        own = shingle_set(t)
        for i, u in items:
            want = shingle_set(u)
            if want and 100 * len(own & want) >= 75 * len(want):
                out.append((d, i, len(own & want), len(want)))
    return sorted(out)


def corpus(seed):
    dice = random.Random(seed)
    words = lambda k: ["".join(dice.choice("abcdefg") for _ in range(3)) for _ in range(k)]
    items = [(k, " ".join(words(dice.choice([1, 3, 5, 6, 9, 20, 40, 57, 130])))) for k in range(60)]
    docs = []
    for k in range(150):
        w = words(dice.choice([0, 10, 100, 2000]))
        for _ in range(dice.randint(0, 2)):
            held = dice.choice(items)[1].split()
            cut = dice.random()
            if cut < 0.3:
                held = held[: max(1, int(len(held) * dice.uniform(0.6, 1)))]
            elif cut < 0.5:
                held[dice.randrange(len(held))] = "other"
            at = dice.randint(0, len(w))
            w[at:at] = held
        docs.append((k, dice.choice([" ", "\n"]).join(w).upper()))
    return docs, items


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_all_pairs(spark, seed):
    docs, items = corpus(seed)
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    i = spark.createDataFrame(items, "item_id long, text string")
    got = sorted((r.doc_id, r.item_id, r.n_shared, r.n_item) for r in matches(d, i).collect())
    assert got == brute(docs, items)
    kept = sorted(r.doc_id for r in without_contaminated(d, i).collect())
    assert kept == sorted({k for k, _ in docs} - {g[0] for g in got})


def test_items_in_blocks(spark):
    _, items = corpus(3)
    i = spark.createDataFrame(items, "item_id long, text string")
    blocks = list(item_blocks(i, 75, block=20))
    assert len(blocks) == 6 and sorted(x for b in blocks for x in b.ids) == [k for k, _ in items]


def test_odd_rows(spark):
    item = "one two three four five six seven"
    docs = [(1, None, "x"), (2, "", "x"), (None, item, "x"), (3, f"{item} " * 20000, "x"), (4, item.upper(), "x"), (4, item, "x"), (5, "tiny", "x")]
    d = spark.createDataFrame(docs, "doc_id long, text string, item_id string")
    i = spark.createDataFrame([(1, item), (2, None), (3, ""), (4, "TINY"), (4, "tiny")], "item_id long, text string")
    got = sorted((r.doc_id or 0, r.item_id) for r in matches(d, i).collect())
    assert got == [(0, 1), (3, 1), (4, 1), (4, 1), (5, 4), (5, 4)]
    kept = without_contaminated(d, i)
    assert kept.columns == d.columns and sorted(r.doc_id for r in kept.collect()) == [1, 2]
    assert matches(d, i.limit(0)).collect() == [] and without_contaminated(d, i.limit(0)).count() == 7
    assert matches(d.limit(0), i).collect() == []


def test_short_items_in_very_long_documents():
    dice = random.Random(4)
    words = [f"w{dice.randrange(10**6)}" for _ in range(40000)]
    items = Items(list(range(200)), [" ".join(words[k * 190 : k * 190 + 15]) for k in range(200)], 75)
    import pyarrow as pa

    from encore.llm.textarrays import slices

    [s] = slices(pa.array([" ".join(words)]))
    assert len(list(items.held(s))) == 200
