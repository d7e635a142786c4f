"""Language of web pages by Bayesian fusion of four kinds of evidence.

    P(lang | page) ~ P(lang | host) * P(text | lang)^temper * P(declared | lang) * P(suffix | lang)

- *Text*: byte trigrams of the visible text, in ``SLOTS`` hashed slots, under a model per
  language with counts over all labelled documents, added-one smoothed. A text's trigrams
  depend on each other, so its log-likelihood is scaled to that of ``TRIGRAMS`` independent
  ones at most.
- *Declared*: the language of the ``lang`` attribute of the page's ``html`` element.
- *Suffix*: the last label of the host name, and a language code as first part of the path.
- *Host*: how the other pages of the host are written, shrunk to its domain, that to the
  suffix, that to all pages: at each level ``SHRINK`` pages' worth of the level above.

The tables P(declared | lang), P(suffix | lang) and the host counts come from all pages by
grouped aggregation of the languages that the text alone gives; shares of a page's own text
are taken out of the counts of its host. Languages are those of the labelled documents; they
and the trigram tables (SLOTS numbers per language) are what the driver holds.

Defined results: a page without html, or without visible text, gives no evidence by text,
and so on for each kind; without any evidence a page gets the shares of all pages. With no
labelled documents the language is null. Pages that repeat count and are reported each.
Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from encore.llm.common import batch_of, take_column
from encore.llm.textarrays import Slice, slices
from encore.scratch import stage

SLOTS = 1 << 16
TRIGRAMS = 60
SHRINK = 5.0
ADD = 0.5


def trigrams(s: Slice) -> tuple[np.ndarray, np.ndarray]:
    """Slot and row of each byte trigram of the lower-cased texts, blanks as one sign."""
    data = s.lower().data.astype(np.uint32)
    data[data <= 0x20] = 0x20
    if len(data) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    code = data[:-2] * 65536 + data[1:-1] * 256 + data[2:]
    row = np.searchsorted(s.offsets, np.arange(len(code)), "right") - 1
    inside = np.arange(len(code)) + 2 < s.offsets[row + 1]
    slot = (code[inside] * np.uint32(2654435761)) >> np.uint32(16)
    return slot.astype(np.int64), row[inside]


def learn(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """(languages, log-probability of each slot by language) from rows (text, lang)."""
    known = docs.filter("lang is not null").select("text", "lang")
    langs = [r.lang for r in known.select("lang").distinct().orderBy("lang").collect()]
    place = {lang: k for k, lang in enumerate(langs)}

    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(langs) * SLOTS, np.int64)
        for batch in batches:
            of = np.array([place[v] for v in take_column(batch, "lang").to_pylist()], np.int64)
            for s in slices(take_column(batch, "text")):
                slot, row = trigrams(s)
                total += np.bincount(of[s.first + row] * SLOTS + slot, minlength=len(total))
        at = np.flatnonzero(total)
        yield batch_of(at=at, n=total[at])

    rows = known.mapInArrow(job, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    counts = np.ones(len(langs) * SLOTS)
    counts[rows.column("at").to_numpy()] += rows.column("n").to_numpy()
    counts = counts.reshape(len(langs), SLOTS)
    return langs, np.log(counts / counts.sum(1, keepdims=True))


def visible(html: Column) -> Column:
    """The text between tags. What is opened and not closed goes on to the end, so no part is read twice."""
    tag = r"<(script|style)\b[^>]*+(?:>(?:.*?</\1\s*+>|.*+)|\z)"
    bare = F.regexp_replace(html, rf"(?is){tag}|<!--(?:.*?-->|.*+)", " ")
    return F.regexp_replace(F.regexp_replace(bare, r"<[^>]*+(?:>|\z)", " "), r"&[#A-Za-z0-9]++;", " ")


def clues(pages: DataFrame) -> DataFrame:
    """page_id and what its markup and address say."""
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*+://([^/?#:@]++)", 1))
    code = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[^/?#]*+//[^/?#]*+/([A-Za-z]{2})(?:[/?#-]|$)", 1))
    declared = F.regexp_extract(F.coalesce("html", F.lit("")), r"(?is)<html\b[^<>]*?\blang\s*+=\s*+[\"']?([A-Za-z]++)", 1)
    labels = F.split("host", r"\.")
    return (
        pages.select("page_id", visible(F.coalesce("html", F.lit(""))).alias("text"), F.lower(declared).alias("declared"),
                     host.alias("host"), code.alias("code"))
        .withColumn("domain", F.array_join(F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), 2), "."))
        .withColumn("top", F.element_at(labels, -1))
        .withColumn("suffix", F.concat_ws("/", F.nullif("top", F.lit("")), F.nullif("code", F.lit(""))))
    )


def text_evidence(pages: DataFrame, model: np.ndarray) -> DataFrame:
    """(…, text array): the scaled log-likelihood of each language in place of the text."""
    languages = len(model)
    rest = [c for c in pages.columns if c != "text"]
    table = np.ascontiguousarray(model.T)

    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in slices(take_column(batch, "text"), 1 << 20):
                slot, row = trigrams(s)
                n = np.bincount(row, minlength=len(s))
                total = np.column_stack([np.bincount(row, table[slot, k], len(s)) for k in range(languages)]).astype(np.float64)
                total *= (np.minimum(n, TRIGRAMS) / np.maximum(n, 1))[:, None]
                total -= total.max(1, keepdims=True)
                part = batch.slice(s.first, len(s))
                yield batch_of(
                    **{c: take_column(part, c) for c in rest},
                    trigrams=n.astype(np.int64),
                    likelihood=pa.ListArray.from_arrays(
                        np.arange(0, languages * len(s) + 1, languages, dtype=np.int32), pa.array(total.ravel())
                    ),
                )

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pages.schema.fields if f.name != "text")
    return pages.mapInArrow(job, f"{schema}, trigrams long, likelihood array<double>")


def _softmax(logs: Column) -> Column:
    shifted = F.transform(logs, lambda x: F.exp(x - F.array_max(logs)))
    return F.transform(shifted, lambda x: x / F.aggregate(shifted, F.lit(0.0), lambda a, b: a + b))


def _sums(df: DataFrame, *keys: str, n: int) -> DataFrame:
    """By key the sums of the components of ``share``, as an array."""
    return df.groupBy(*keys).agg(F.array(*[F.sum(F.get("share", F.lit(k))) for k in range(n)]).alias("sums"))


def _shrunk(counts: Column, above: Column) -> Column:
    total = F.aggregate(counts, F.lit(0.0), lambda a, b: a + b)
    return F.zip_with(counts, above, lambda c, a: (c + SHRINK * a) / (total + SHRINK))


def identify(pages: DataFrame, docs: DataFrame) -> DataFrame:
    """page_id, lang, probability, text_lang, declared, suffix, host: one row per page."""
    langs, model = learn(docs)
    n = len(langs)
    found = clues(pages)
    if not n:
        none = [F.lit(None).cast(t).alias(c) for c, t in (("lang", "string"), ("probability", "double"))]
        return found.select("page_id", *none, F.lit(None).cast("string").alias("text_lang"), "declared", "suffix", "host")
    # a page without text says nothing about its host, address or markup
    share = F.when(F.col("trigrams") > 0, _softmax(F.col("likelihood"))).otherwise(F.array(*[F.lit(0.0)] * n))
    scored, _ = stage(text_evidence(found, model).withColumn("share", share), "page-evidence")
    overall = scored.agg(*[F.sum(F.get("share", F.lit(k))) for k in range(n)]).first()
    overall = np.array([v or 0.0 for v in overall]) + ADD
    everywhere = F.array(*map(F.lit, (overall / overall.sum()).tolist()))

    # hosts within domains within suffixes within all pages
    hosted = scored.filter("host != ''")
    tops = _sums(hosted, "top", n=n).select("top", _shrunk(F.col("sums"), everywhere).alias("top_prior"))
    domains = _sums(hosted, "top", "domain", n=n).join(tops, "top")
    domains = domains.select("domain", _shrunk(F.col("sums"), F.col("top_prior")).alias("domain_prior"))
    hosts, _ = stage(
        _sums(hosted, "domain", "host", n=n)
        .join(domains, "domain")
        .select(F.col("host").alias("_host"), "sums", "domain_prior"),
        "hosts",
    )
    # P(clue | lang), a constant per language left out where it is the same for all clues
    def given(clue: str) -> DataFrame:
        return _sums(scored.filter(F.col(clue) != ""), clue, n=n).select(
            F.col(clue).alias(f"_{clue}"),
            F.zip_with(F.col("sums"), everywhere, lambda c, a: F.log((c + ADD * a) / a)).alias(f"given_{clue}"),
        )

    declared, suffix = (stage(given(c), f"given-{c}")[0] for c in ("declared", "suffix"))
    nothing = F.array(*[F.lit(0.0)] * n)
    own = F.zip_with(F.coalesce("sums", nothing), "share", lambda c, s: F.greatest(c - s, F.lit(0.0)))
    joined = (
        scored.join(hosts, F.col("host") == F.col("_host"), "left")
        .join(declared, F.col("declared") == F.col("_declared"), "left")
        .join(suffix, F.col("suffix") == F.col("_suffix"), "left")
    )
    prior = F.transform(_shrunk(own, F.coalesce("domain_prior", everywhere)), lambda p: F.log(p))
    parts = [prior, F.col("likelihood"), F.coalesce("given_declared", nothing), F.coalesce("given_suffix", nothing)]
    logs = reduce(lambda a, b: F.zip_with(a, b, lambda x, y: x + y), parts)
    names = F.array(*map(F.lit, langs))
    best = lambda c: F.get(names, F.array_position(c, F.array_max(c)).cast("int") - 1)
    return (
        joined.withColumn("logs", logs)
        .withColumn("fused", _softmax(F.col("logs")))
        .select(
            "page_id", best(F.col("fused")).alias("lang"), F.array_max("fused").alias("probability"),
            F.when(F.col("trigrams") > 0, best(F.col("likelihood"))).alias("text_lang"), "declared", "suffix", "host",
        )
    )
