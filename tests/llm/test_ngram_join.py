"""The n-gram join against all pairs."""

import random
import re

import pytest

from encore.llm import verify
from encore.llm.ngram_join import near_duplicates, one_of_each

LOWER = {i: i + 32 for i in range(65, 91)}


def shingle_set(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(rows):
    sets = [shingle_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    return {doc_id: (len(sets[i]), least[find(i)]) for i, (doc_id, _) in enumerate(rows)}


def corpus(seed, n=160):
    """Unrelated texts, edits of a few bases, a passage most texts share, and small ones."""
    dice = random.Random(seed)
    word = lambda: "".join(dice.choice("abcdefghij") for _ in range(dice.randint(1, 3)))
    passage = [word() for _ in range(40)]
    bases = [[word() for _ in range(dice.randint(20, 120))] for _ in range(4)]
    rows = []
    for k in range(n):
        kind = dice.random()
        if kind < 0.5:
            w = list(bases[k % 2 if kind < 0.35 else dice.randrange(4)])
            for _ in range(dice.randint(0, 4)):
                w[dice.randrange(len(w))] = word()
            if dice.random() < 0.2:
                w = w[: dice.randint(len(w) * 3 // 4, len(w))]
        elif kind < 0.75:
            w = [word() for _ in range(dice.randint(5, 60))] + passage
        elif kind < 0.9:
            w = passage + [word() for _ in range(dice.randint(0, 12))]
        else:
            w = [word() for _ in range(dice.randint(0, 6))]
        text = dice.choice([" ", "\n", "  "]).join(w)
        rows.append((1000 - 3 * k, text.upper() if dice.random() < 0.1 else text))
    return rows


@pytest.mark.parametrize("seed, hot", [(1, 256), (2, 2), (3, 6), (4, 20)])
def test_equals_all_pairs(spark, seed, hot):
    rows = corpus(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(docs, hot).collect()}
    assert got == brute(rows)


def test_blocks_of_hot_tiles(spark, monkeypatch):
    monkeypatch.setattr("encore.llm.verify.BLOCK", 8)
    rows = corpus(5, 220)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(docs, 3).collect()}
    assert got == brute(rows)


def test_odd_rows(spark):
    long = " ".join(f"w{i}" for i in range(30000))
    rows = [
        (5, None, "x"), (4, "", "x"), (3, " \n\t", "x"), (9, "A b c", "x"), (8, "a B  c", "x"), (7, "a b c d e", "x"),
        (2, long, "x"), (1, long + " end", "x"), (None, "a b c", "x"), (6, "a b c d e", "x"), (6, "a b c d e", "x"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, node string")
    got = sorted((r.doc_id or 0, r.n_shingles, r.component_id) for r in near_duplicates(docs).collect())
    assert got == [
        (0, 1, None), (1, 29997, 1), (2, 29996, 1), (3, 0, 3), (4, 0, 4), (5, 0, 5), (6, 1, 6), (6, 1, 6), (7, 1, 6),
        (8, 1, 8), (9, 1, 8),
    ]
    kept = one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 3, 4, 5, 6, 6, 8]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert near_duplicates(docs).collect() == [] and one_of_each(docs).collect() == []


def test_few_rows_go_to_few_files(spark, tmp_path, monkeypatch):
    """Links are made in many tasks, and a file for each would start processes from the executors."""
    monkeypatch.setattr("encore.scratch.shared_root", lambda _: str(tmp_path))
    parts = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    try:
        rows = [(2 * i + j, " ".join(f"w{i}x{k}" for k in range(40)) + " end" * j) for i in range(60) for j in range(2)]
        found = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", parts)
    assert {r.doc_id: r.component_id for r in found} == {i: i - i % 2 for i in range(120)}
    files = {}
    for folder in tmp_path.iterdir():
        label = folder.name.split("-")[1]
        files[label] = max(files.get(label, 0), len(list(folder.glob("part-*"))))
    assert {files[label] for label in ("possible", "edges", "links")} == {1}, files


def test_members_of_groups_are_made_once(spark, monkeypatch):
    """Several jobs read them: were they not stored, the driver would plan and run their joins in each."""
    seen, verified = [], verify._verified

    def looked_at(members, sets, percent):
        seen.append(members._jdf.queryExecution().optimizedPlan().toString())
        return verified(members, sets, percent)

    monkeypatch.setattr(verify, "_verified", looked_at)
    rows = corpus(5, 60)
    found = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), hot=8)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found.collect()} == brute(rows)
    assert seen and not [p for p in seen if "Join" in p or "Aggregate" in p]
