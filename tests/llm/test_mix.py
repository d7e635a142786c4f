"""The source mix: targets in closed form, closeness, and reruns."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from encore.llm.source_mix import mix_sources, numbered


def targets(sizes):
    """By source name: the sources in order of words per weight, each capped or at the level."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: 1 + k % 3 for k, s in enumerate(names)}
    left, open_ = sum(sizes.values()), sum(weight.values())
    out = {}
    for s in sorted(names, key=lambda s: 3 * sizes[s] / weight[s]):
        out[s] = min(3.0 * sizes[s], weight[s] * left / open_)
        left -= out[s]
        open_ -= weight[s]
    return out


def corpus(seed, sources=7, n=400):
    dice = random.Random(seed)
    names = [f"src{k}" for k in range(sources - 1)] + [None]
    rows = []
    for k in range(n):
        source = names[0] if dice.random() < 0.4 else dice.choice(names)
        words = 0 if dice.random() < 0.05 else int(dice.lognormvariate(3, 1))
        rows.append((k, source, " ".join(["w"] * words) if words else dice.choice([None, "", " \n"])))
    return rows


@pytest.mark.parametrize("seed, sources", [(1, 7), (2, 2), (3, 12), (4, 1)])
def test_targets_and_closeness(spark, seed, sources):
    rows = corpus(seed, sources)
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(3)
    got = mix_sources(docs, buckets=16).collect()
    sizes = {}
    for _, s, t in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    want = targets(sizes)
    taken = {}
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        assert r.taken == r.copies * r.size and 0 <= r.taken <= 3 * r.size
        floor = int(r.target // r.source_size) if r.source_size else 0
        assert r.size == 0 or r.copies in (floor, floor + 1)
        taken[r.source] = taken.get(r.source, 0) + r.taken
    assert len(got) == len(rows)
    smallest = min(r.size for r in got if r.size)
    for s in sizes:
        assert abs(taken[s] - want[s]) <= max(0.02 * want[s], 2 * smallest, 3)
    assert sum(want.values()) == pytest.approx(min(sum(sizes.values()), 3 * sum(sizes.values())))


def test_reruns_agree_whatever_the_partitions(spark):
    docs = spark.createDataFrame(corpus(9), "doc_id long, source string, text string")
    one = mix_sources(docs.repartition(5)).orderBy("doc_id").collect()
    assert mix_sources(docs.coalesce(1), buckets=3).orderBy("doc_id").collect() == one


def test_larger_inclusion_odds_are_sampled_more(spark):
    """A third of a source of short and long texts: long ones are taken more often."""
    rows = [(k, "a", "w " * (4 if k % 2 else 40)) for k in range(2000)] + [(k, "b", "w " * 22) for k in range(2000, 6000)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    got = mix_sources(docs, weights=(1, 8)).filter("source = 'a'").groupBy("size").agg(F.avg("copies").alias("share"))
    share = {r["size"]: r["share"] for r in got.collect()}
    assert 0 < share[4] < share[40] < 1


def test_odd_rows(spark):
    rows = [(None, "a", "x y", 1), (None, "a", "x y", 1), (1, "a", "x y", 2), (1, "a", "x y", 2), (2, None, None, 3), (3, "b", "", 4)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string, size int")
    got = mix_sources(docs).collect()
    assert len(got) == 6 and sum(r.taken for r in got) == 8
    assert mix_sources(docs.limit(0)).collect() == []
    nothing = mix_sources(docs.filter("text is null or text = ''")).collect()
    assert [r.taken for r in nothing] == [0, 0] and {r.target for r in nothing} == {0.0}


def test_stage_goes_on_past_texts_that_do_not_fit(spark):
    """The long text ranks first mostly and is longer than what its source may still take."""
    rows = [(0, "a", "w " * 1000)] + [(k, "a", "w " * 5) for k in range(1, 201)]
    rows += [(k, "b", "w " * 4) for k in range(201, 1501)]
    for shift in range(0, 9000, 3000):
        docs = spark.createDataFrame([(k + shift, s, t) for k, s, t in rows], "doc_id long, source string, text string")
        got = {r.source: r for r in corpus_pipeline.mixing(spark, docs, "").groupBy("source").agg(
            F.sum("taken").alias("taken"), F.first("target").alias("target")).collect()}
        assert got["a"].target == 2400 and abs(got["a"].taken - 2400) <= 5
        assert abs(got["b"].taken - got["b"].target) <= 4


def test_equal_rows_are_numbered_in_runs(spark, monkeypatch):
    """A third of all rows are alike; the result is that of numbering them in one go, and no window holds them."""
    rows = [(7, "a", "w " * 3)] * 500 + [(None, None, "w")] * 30 + [(k, "b", "w " * (k % 9)) for k in range(1000)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    whole = sorted(mix_sources(docs).collect(), key=str)
    monkeypatch.setattr("encore.llm.source_mix.RUN", 16)
    assert sorted(mix_sources(docs.repartition(5)).collect(), key=str) == whole and len(whole) == len(rows)
    got = numbered(docs.select("doc_id", "source", F.lit(1).cast("long").alias("size")))
    assert sorted(r["repeat"] for r in got.filter("source = 'a'").collect()) == list(range(1, 501))
    assert "Window" not in got._jdf.queryExecution().executedPlan().toString()
