"""The chosen-path join against all pairs."""

import random

import numpy as np
import pyarrow as pa
import pytest
from test_ngram_join import corpus, shingle_set

from encore.llm import chosen_path
from encore.llm.chosen_path import ALIKE, WIDTH, chosen_places, near_duplicates, signatures
from encore.llm.textarrays import mix


def brute(rows, percent=85):
    sets = [shingle_set(t) for _, t in rows]
    group = list(range(len(rows)))

    def find(x):
        while group[x] != x:
            x = group[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                group[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    return {d: (len(sets[i]), least[find(i)], d == least[find(i)]) for i, (d, _) in enumerate(rows)}


def found(df):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in df.collect()}


@pytest.mark.parametrize("seed, small", [(1, 256), (2, 3), (3, 8)])
def test_equals_all_pairs(spark, monkeypatch, seed, small):
    monkeypatch.setattr(chosen_path, "SMALL", small)
    rows = corpus(seed, 200)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert found(near_duplicates(docs)) == brute(rows)


def test_links_at_the_threshold_survive(spark):
    """Pairs of similarity 0.85 to 0.87 with nobody else like them: recall of the links."""
    dice = random.Random(7)
    word = lambda: "".join(dice.choice("abcdefghij") for _ in range(6))
    rows = []
    for k in range(400):
        base = [word() for _ in range(104)]  # 100 shingles; a new end of m words leaves (100 - m) / (100 + m)
        rows += [(2 * k, " ".join(base)), (2 * k + 1, " ".join(base[: 104 - 7] + [word() for _ in range(7)]))]
    got = found(near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")))
    want = brute(rows[:2])
    assert want[1][1] == 0, "93 of 107 shingles are common"
    assert sum(got[2 * k + 1][1] == 2 * k for k in range(400)) >= 399
    few = found(near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), trees=1))
    assert 300 <= sum(few[2 * k + 1][1] == 2 * k for k in range(400)) < 400, "one tree misses some"


def test_large_nodes_branch_until_they_are_connected(spark, monkeypatch):
    """Many texts with one long passage, which alone does not link them, and two groups of edits among them."""
    monkeypatch.setattr(chosen_path, "SMALL", 6)
    monkeypatch.setattr("encore.llm.verify.BLOCK", 7)
    dice = random.Random(8)
    word = lambda: "".join(dice.choice("abcdefghij") for _ in range(5))
    passage = [word() for _ in range(60)]
    rows = [(k, " ".join(passage + [word() for _ in range(20 + k % 9)])) for k in range(120)]
    for g in range(2):
        base = passage + [word() for _ in range(60)]
        for k in range(60):
            w = list(base)
            w[70 + dice.randrange(40)] = word()
            rows.append((1000 * (g + 1) + k, " ".join(w)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(near_duplicates(docs)) == brute(rows)


def test_odd_rows(spark):
    long = " ".join(f"w{i}" for i in range(30000))
    rows = [
        (5, None, "x"), (4, "", "x"), (3, " \n\t", "x"), (9, "A b c", "x"), (8, "a B  c", "x"), (7, "a b c d e", "x"),
        (2, long, "x"), (1, long + " end", "x"), (None, "a b c", "x"), (6, "a b c d e", "x"), (6, "a b c d e", "x"),
    ]
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, node string, n int, path int")
    got = sorted((r.doc_id or 0, r.n_shingles, r.component_id, r.kept) for r in near_duplicates(docs).collect())
    assert got == [
        (0, 1, None, True), (1, 29997, 1, True), (2, 29996, 1, False), (3, 0, 3, True), (4, 0, 4, True), (5, 0, 5, True),
        (6, 1, 6, True), (6, 1, 6, True), (7, 1, 6, False), (8, 1, 8, True), (9, 1, 8, False),
    ]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert near_duplicates(docs).collect() == []


def test_signatures_agree_as_often_as_sets_are_alike():
    rng = np.random.default_rng(1)
    agree = []
    for _ in range(200):
        values = mix(rng.integers(0, 1 << 62, 430, dtype=np.uint64))
        a, b = np.sort(values[:400]), np.sort(values[30:])  # 370 of 430
        rows = signatures(np.concatenate([a, b]), np.array([0, 400, 800]))
        agree.append((rows[0] == rows[1]).sum())
    assert abs(np.mean(agree) / WIDTH - 370 / 430) < 0.01 and min(agree) >= ALIKE


def test_paths_choose_one_place_and_sometimes_a_second():
    one, two = chosen_places(mix(np.arange(100_000, dtype=np.uint64)))
    assert abs((two >= 0).mean() - (1 / 0.85 - 1)) < 0.01 and (one != two).all()
    assert np.bincount(one, minlength=WIDTH).min() > 1300


def test_copies_take_part_once(spark):
    text = "one two three four five six seven"
    docs = spark.range(3000).selectExpr("id as doc_id", f"if(id % 2 = 0, '{text}', concat('{text} ', id)) as text")
    got = found(near_duplicates(docs))
    assert {got[k][1] for k in range(0, 3000, 2)} == {0} and got[2] == (3, 0, False)


def test_sets_are_signed_within_the_step(monkeypatch):
    """Many long texts are not hashed at once, and their signatures are those of each text alone."""
    monkeypatch.setattr(chosen_path, "STEP", 1000)
    sizes = []

    def counted(values, first):
        sizes.append(len(values))
        return signatures(values, first)

    monkeypatch.setattr(chosen_path, "signatures", counted)
    texts = [" ".join(f"w{k}x{i}" for i in range(100)) for k in range(40)] + [" ".join(f"v{i}" for i in range(3000)), "", "one"]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(len(texts))), "text": texts})
    got = [r for b in chosen_path._profiles(batch) for r in b.to_pylist()]
    assert sorted(sizes)[-1] == 2996 and sorted(sizes)[-2] <= 1000
    alone = [next(chosen_path._profiles(batch.slice(k, 1))).to_pylist()[0] for k in range(len(texts))]
    assert got == alone
