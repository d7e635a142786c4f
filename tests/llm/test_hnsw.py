"""Nearest neighbours against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from encore.llm.hnsw import SHARDS, build_index, nearest_neighbours, usable


def brute(rows, asking, k):
    rows = sorted(set((i, tuple(v)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)))
    out = {}
    for i, q in rows:
        if asking(i):
            found = [(-float(np.dot(q, v)), j) for j, v in rows if j != i and len(v) == len(q)]
            out[i] = [(j, -s) for s, j in sorted(found)[:k]]
    return out


def search(spark, rows, k=5, every=2):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = {}
    for r in nearest_neighbours(df, F.col("vec_id") % every == 0, k).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    return {q: [v[r] for r in sorted(v)] for q, v in got.items()}, {q: sorted(v) for q, v in got.items()}


def test_lengths_ties_and_copies(spark):
    """Longer vectors are nearer by inner product; equal ones tie and the smaller id is first."""
    dice = np.random.default_rng(0)
    rows = [(i, dice.integers(-5, 6, size=6).astype(float).tolist()) for i in range(300)]
    hot = rows[0][1]
    rows += [(1000 + i, hot) for i in range(120)]
    found, ranks = search(spark, rows)
    want = brute(rows, lambda i: i % 2 == 0, 5)
    assert {q: [j for j, _ in v] for q, v in found.items()} == {q: [j for j, _ in v] for q, v in want.items()}
    for q, v in found.items():
        assert np.allclose([s for _, s in v], [s for _, s in want[q]], rtol=0, atol=1e-9)
        assert ranks[q] == [1, 2, 3, 4, 5]


def test_odd_rows(spark):
    nan = float("nan")
    rows = [
        (0, [1.0, 0.0]), (2, [0.5, 0.5]), (2, [0.5, 0.5]), (4, None), (6, []), (8, [0.0, 0.0]), (10, [nan, 1.0]),
        (12, [1.0, None]), (14, [float("inf"), 1.0]), (None, [1.0, 1.0]), (16, [1.0, 2.0, 3.0]), (1, [-1.0, 0.25]),
    ]
    found, _ = search(spark, rows, k=20)
    assert found == {0: [(2, 0.5), (1, -1.0)], 2: [(0, 0.5), (1, -0.375)]}
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, score double")
    assert nearest_neighbours(df, F.lit(True)).collect() == []


@pytest.mark.parametrize("beam, least", [(160, 0.99), (30, 0.8)])
def test_recall(spark, monkeypatch, beam, least):
    monkeypatch.setattr("encore.llm.hnsw.SHARDS", 1)
    dice = np.random.default_rng(1)
    vectors = dice.normal(size=(3000, 24))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>")
    got = {}
    for r in nearest_neighbours(df, F.col("vec_id") % 50 == 0, 20, beam).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    hits = 0
    for q in range(0, 3000, 50):
        near = np.argsort(-(vectors @ vectors[q]))
        hits += len(set(near[near != q][:20].tolist()) & got[q])
    assert hits / (60 * 20) >= least


def test_unit_vectors_are_in_one_band_and_graphs_in_tasks_of_their_own(spark):
    """Rounding brings lengths to both sides of 1; few bytes are much work, so AQE is not to join tasks by bytes."""
    dice = np.random.default_rng(2)
    vectors = dice.normal(size=(400, 8))
    vectors = (vectors / np.linalg.norm(vectors, axis=1, keepdims=True)).astype(np.float32).astype(float)
    lengths = np.linalg.norm(vectors, axis=1)
    assert (lengths < 1).any() and (lengths > 1).any()
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    graphs = build_index(usable(df), 5)
    assert graphs.count() == SHARDS
    assert len(graphs.select(F.input_file_name().alias("file")).distinct().collect()) > SHARDS / 3
