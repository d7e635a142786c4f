"""From raw documents to a training mix: five stages, each one operator.

``STAGES`` lists them in order. A stage takes (spark, docs, sf_dir) and returns the documents
it keeps, with the columns of ``documents``; the last returns the mix. ``run`` writes what a
stage returns as Parquet below ``spark.checkpoint.dir`` and reads it again as the next one's
documents, so a lost executor costs at most the stage it was in.

Defined results, beside those of the operators: rows that share a doc_id are one document
to the near-duplicate stage and stay or go together; a null doc_id stays through it. An empty
table passes through all stages.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from encore.llm.common import table
from encore.llm.decontaminate import without_contaminated
from encore.llm.line_dedup import dedup_lines
from encore.llm.ngram_join import one_of_each
from encore.llm.quality import score_quality
from encore.llm.source_mix import mix_sources
from encore.scratch import new_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    kept = score_quality(docs, table(spark, sf_dir, "labels")).filter("predicted = 1")
    return kept.select(*docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier document has go; n_chars is that of the text that stays."""
    kept = dedup_lines(docs)
    changed = F.when(F.col("lines_dropped") > 0, F.length("text").cast("long"))
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.coalesce(changed, "n_chars"))
    return kept.select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, the one with the smallest doc_id."""
    return one_of_each(docs).select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How often each document is taken, by source weights."""
    return mix_sources(docs).select("doc_id", "source", "size", "source_size", "target", "copies", "taken")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("lines", lines),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
]

#: The classifier has no SQL form; tests hold the stages against plain versions instead.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = new_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
