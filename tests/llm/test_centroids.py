"""Centroid clustering against plain k-means on whole numbers."""

import hashlib
import math

import numpy as np
import pytest

from encore.llm import centroids
from encore.llm.centroids import BLOCK, candidates, cluster, hilbert, nearest, zone_blocks

SCHEMA = "vec_id long, embedding array<double>"


def plain(rows, k=40, rounds=5):
    kept = [
        (i, [min(max(math.floor(min(max(256 * x, -(2.0**40)), 2.0**40)), -(1 << 27)), 1 << 27) for x in v])
        for i, v in rows
        if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)
    ]
    name = [hashlib.sha256(f"2:{'' if i is None else i}".encode()).hexdigest() for i, _ in kept]
    order = sorted(range(len(kept)), key=lambda j: (name[j], np.array(kept[j][1], np.int32).tobytes()))
    middle = [kept[j][1] for j in order[:k]]

    def assign():
        out = []
        for _, v in kept:
            away = [sum((a - b) ** 2 for a, b in zip(v, c, strict=True)) for c in middle]
            out.append((away.index(min(away)), min(away)))
        return out

    for _ in range(rounds):
        own = assign()
        for c in range(len(middle)):
            members = [v for (_, v), (o, _) in zip(kept, own, strict=True) if o == c]
            if members:
                middle[c] = [sum(x) // len(members) for x in zip(*members, strict=True)]
    own = assign()
    total = min(sum(d for _, d in own), (1 << 63) - 1)
    of = [min(sum(d for o, d in own if o == c), (1 << 63) - 1) for c in range(len(middle))]
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in middle]
    return sorted(((i, o, d, of[o], total, sha[o]) for (i, _), (o, d) in zip(kept, own, strict=True)), key=str)


def check(spark, rows, schema=SCHEMA):
    got = cluster(spark.createDataFrame(rows, schema))
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == plain([r[:2] for r in rows])


def test_against_plain_python(spark):
    rng = np.random.default_rng(3)
    middle = rng.normal(size=(12, 64))
    rows = [(k * 3 - 50, (middle[k % 12] + rng.normal(size=64) * 0.3).tolist()) for k in range(400)]
    check(spark, rows)


def test_nulls_ties_copies_and_clashing_columns(spark):
    rng = np.random.default_rng(4)
    vector = rng.normal(size=64).tolist()
    rows = [(k, vector) for k in range(60)] + [(None, vector), (None, None), (7, None), (8, []), (9, [1.0] * 63), (10, [1.0] * 65)]
    rows += [(11, [None] + [1.0] * 63), (12, [float("nan")] + [1.0] * 63), (13, [float("inf")] + [1.0] * 63)]
    rows += [(5, rng.normal(size=64).tolist()) for _ in range(5)]
    check(spark, [(*r, 1, "x", 2.0) for r in rows], f"{SCHEMA}, cluster int, vector string, place double")


def test_wild_vectors(spark):
    rng = np.random.default_rng(5)
    scales = [1e30, 1e-30, 1.0, 1e4, 1e6]
    check(spark, [(k, (rng.normal(size=64) * scales[k % 5]).tolist()) for k in range(100)])


def test_few_vectors_and_empty_tables(spark):
    check(spark, [(1, [0.5] * 64)])
    check(spark, [(k, [k / 256] * 64) for k in (4, 2, 9)])
    assert cluster(spark.createDataFrame([], SCHEMA)).collect() == []
    assert cluster(spark.createDataFrame([(1, [1.0])], SCHEMA)).collect() == []


def test_the_curve_visits_neighbours():
    bits, side = 3, 8
    for dims in (2, 3):
        cells = np.stack(np.meshgrid(*[np.arange(side)] * dims, indexing="ij"), -1).reshape(-1, dims)
        place = [int.from_bytes(p.tobytes(), "big") >> (-bits * dims % 8) for p in hilbert(cells, bits)]
        assert sorted(place) == list(range(side**dims))
        walk = cells[np.argsort(place)]
        assert (np.abs(np.diff(walk, axis=0)).sum(1) == 1).all()


def test_candidates_hold_the_nearest_and_leave_others_out():
    rng = np.random.default_rng(6)
    middle = rng.integers(-2000, 2000, (40, 64))
    out = 0
    for c in middle:
        x = c + rng.integers(-300, 300, (50, 64))
        few = candidates(x.min(0)[None], x.max(0)[None], middle)[0]
        assert few[nearest(x, middle)[0]].all()
        out += 40 - few.sum()
    assert out > 40 * 30


def test_large_numbers_stay_exact():
    x = np.array([[1 << 27] * 64, [-(1 << 27)] * 64], np.int64)
    best, away = nearest(x, np.array([[-(1 << 27)] * 64, [(1 << 27) - 1] * 64], np.int64))
    assert best.tolist() == [1, 0] and away.tolist() == [64, 0]
    assert 64 * (1 << 28) ** 2 < 1 << 63


def test_a_vector_of_many_rows_is_many_blocks(spark):
    n = 12 * BLOCK
    rows = spark.range(n).selectExpr("id as vec_id", "if(id % 3 = 0, array_repeat(0.25D, 64), transform(sequence(1, 64), i -> (id * i % 97) / 97D)) as embedding")
    blocks = zone_blocks(centroids.kept_vectors(rows)).collect()
    assert sum(len(b["vec_ids"]) for b in blocks) == n and max(len(b["vec_ids"]) for b in blocks) <= BLOCK
    same = [b for b in blocks if b["low"] == b["high"]]
    assert len(same) >= 2 and len(blocks) >= 12


@pytest.mark.parametrize("seed", [0, 1])
def test_box_bounds_are_true_bounds(seed):
    rng = np.random.default_rng(seed)
    x, c = rng.integers(-50, 50, (20, 64)), rng.integers(-50, 50, (7, 64))
    away = ((x[:, None] - c[None]) ** 2).sum(2)
    few = candidates(x.min(0)[None], x.max(0)[None], c)[0]
    assert few[away.argmin(1)].all()
