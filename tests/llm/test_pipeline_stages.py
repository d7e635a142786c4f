"""The corpus pipeline: each stage on the input it gets."""

import re

from pyspark.sql import functions as F

import corpus_pipeline
from test_decontaminate import brute as contaminated
from test_lines import brute as lines
from test_ngram_join import brute as components

SF_DIR = "/root/testdata/sf0.001"


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns = docs.columns
    steps = [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, steps[-1], SF_DIR).write.parquet(f"{tmp_path}/{name}")
        steps.append(spark.read.parquet(f"{tmp_path}/{name}"))
    start, good, lined, single, clean, mixed = steps
    assert all(s.columns == columns for s in (good, lined, single, clean))

    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    kept = {d for d, _ in pairs(good)}
    known = [d for d, _ in pairs(start) if labels.get(d) == 1]
    assert sum(d in kept for d in known) >= 0.95 * len(known)
    assert sum(d in kept for d, q in labels.items() if q == 0) <= 0.5 * sum(q == 0 for q in labels.values())

    want = {d: text for d, _, _, text in lines(pairs(good))}
    assert dict(pairs(lined)) == want
    assert lined.filter(F.length("text") != F.col("n_chars")).count() == 0

    part = components(pairs(lined))
    assert sorted(d for d, _ in pairs(single)) == sorted(d for d, (_, least) in part.items() if d == least)

    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    bad = {d for d, *_ in contaminated(pairs(single), items)}
    assert sorted(d for d, _ in pairs(clean)) == sorted({d for d, _ in pairs(single)} - bad)

    sizes = {d: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for d, t in pairs(clean)}
    rows = mixed.collect()
    assert {r.doc_id: r["size"] for r in rows} == sizes
    assert abs(sum(r.taken for r in rows) - sum(sizes.values())) <= 0.1 * sum(sizes.values())


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_DIR)
        assert docs.count() == 0
