"""Toxicity by two Kneser-Ney language models, one of toxic and one of ordinary documents.

Both models are bigrams with absolute discounting:

    P_c(w | h) = max(n_c(h w) - D2_c, 0) / n_c(h .) + left_c(h) * P_c(w)
    P_c(w)     = max(n_c(w) - D1_c, 0) / n_c + left_c * B(w)

with n_c the number of documents of a class that hold an expression, over all labelled
documents to learn from, and ``left`` the mass that the discounts take away. Each D is
n1 / (n1 + 2 n2), from the numbers of words or bigrams that one and two documents of the class hold.
Counting documents and not places keeps one long or repetitive document from
speaking for its class. B(w) is one backoff for both classes, by Kneser-Ney's continuation counts: the
share of w among the distinct (word before, word) pairs of labelled documents, where the beginning of
a text counts as one more word before each. Expressions that neither class holds in more than
``CUTOFF`` documents are left to the backoff, as is usual for n-gram models, with all their mass; of
the others all counts tell. (Without a cut-off for words 1.3 to 2.2 times as many held-out rows are told wrong.)

A document's evidence is the difference of the two log-likelihoods over its distinct words
and bigrams, per expression and per square root of their number, and the part of it that
comes from expressions at least e^``STRONG`` times likelier in toxic text, in the same
measure. The difference is a sum of values per expression, and all words below the
cut-off add the same constant, so only the others need a value, without loss. Values are rounded to
32-bit floats for either way to the documents. They go
to the documents by broadcast if they are counted to be at most ``MODEL_ROWS``; beyond that
documents send their expressions to the values in a shuffled join, with the same result.

A logistic regression calibrates the evidence on documents that the counts leave out: a
fifth of the ones to learn from, ``CALIBRATION_ROWS`` at most (those with the smallest
hashes of ids).

Words are runs of letters, digits, apostrophes and non-ASCII characters, A-Z lower-cased. They
are numbered by 32 bits of a hash, so of a million words about 116 pairs count as one word each.
Defined results: a null or empty text has difference 0 and the score that the regression
gives it; without labels of both classes all scores are the share of class 1 (0 without
any). Rows that repeat are scored alike. Further columns are carried along; a column that
clashes with a new one is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from encore.llm.common import (
    arrow_map,
    batch_of,
    bounded_broadcast,
    fit_logistic,
    fold,
    one_label,
    take_column,
)
from encore.llm.textarrays import Slice, distinct, hashes, mix, signed, slices, spans
from encore.scratch import stage

CLASSES = ("toxic", "ordinary")
CUTOFF = 2
STRONG = 2.0
MODEL_ROWS = 4_000_000
CALIBRATION_ROWS = 50_000
FOLDS = 4
HELD_OUT = 2
THRESHOLD = 0.3
FLUSH = 2_000_000
COUNTS = ("toxic", "ordinary", "documents", "after_toxic", "after_ordinary")
EVIDENCE = ("difference", "strong", "n_expressions")

_BREAK = np.ones(256, bool)
_BREAK[[*range(ord("a"), ord("z") + 1), *range(ord("0"), ord("9") + 1), ord("'"), *range(0x80, 0x100)]] = False


def tokens(s: Slice) -> tuple[np.ndarray, np.ndarray]:
    """A 32-bit number, never 0, and the row of each word."""
    s = s.lower()
    start, end = spans(s, _BREAK)
    word = np.maximum(hashes(s.data, start, end) >> np.uint64(32), np.uint64(1))
    return word, np.searchsorted(s.offsets, start, "right") - 1


@dataclass
class Expressions:
    """The distinct words and the distinct bigrams of each text of a slice.

    A bigram is the number of its first word, shifted, and that of its second.
    """

    word_row: np.ndarray
    word: np.ndarray
    gram_row: np.ndarray
    gram: np.ndarray

    @property
    def history(self) -> np.ndarray:
        return self.gram >> np.uint64(32)


def expressions(s: Slice) -> Expressions:
    word, row = tokens(s)
    words = distinct((row.astype(np.uint64) << np.uint64(32)) | word)
    at = np.flatnonzero(row[1:] == row[:-1])
    gram = (word[at] << np.uint64(32)) | word[at + 1]
    # a slice has fewer than 2^20 rows; 44 bits tell the bigrams of one text apart
    key = (row[at].astype(np.uint64) << np.uint64(44)) | (mix(gram) >> np.uint64(20))
    order = np.argsort(key)  # not stable, and so much faster than np.unique's
    key = key[order]
    first = order[np.concatenate([[True], key[1:] != key[:-1]])] if len(key) else order
    return Expressions(
        (words >> np.uint64(32)).astype(np.int64), words & np.uint64(0xFFFFFFFF), row[at][first], gram[first]
    )


class Tally:
    """Sums of counts by key that are handed on before they grow beyond FLUSH keys."""

    def __init__(self):
        self.keys, self.counts, self.size = [], [], 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.keys.append(keys)
        self.counts.append(counts)
        self.size += len(keys)

    def take(self) -> Iterator[pa.RecordBatch]:
        if self.size:
            keys, of = np.unique(np.concatenate(self.keys), return_inverse=True)
            counts = np.concatenate(self.counts)
            sums = {
                name: np.bincount(of, counts[:, k], len(keys)).astype(np.int64) for k, name in enumerate(COUNTS)
            }
            yield batch_of(gram=signed(keys), **sums)
        self.__init__()


def _counting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(gram, COUNTS) summed over what a task has seen.

    A word is the gram without a history. ``documents`` counts words in all documents,
    ``after_`` the bigrams that begin with a word. Gram 0 has the sums of all words.
    """
    tally = Tally()
    for batch in batches:
        label = take_column(batch, "y").to_numpy(zero_copy_only=False).astype(float)  # NaN: not to learn from
        for s in slices(take_column(batch, "text")):
            x = expressions(s)
            known, both = label[s.first + x.word_row], label[s.first + x.gram_row]
            use = both >= 0
            grams = [
                (x.word, known, (0, 1, 2)),
                (x.gram[use], both[use], (0, 1)),
                (x.history[use], both[use], (3, 4)),
            ]
            for gram, y, places in grams:
                kinds, of = np.unique(gram, return_inverse=True)
                counts = np.zeros((len(kinds), len(COUNTS)), np.int32)
                for place, counted in zip(places, (y == 1, y == 0, y != -1), strict=False):
                    counts[:, place] = np.bincount(of[counted], minlength=len(kinds))
                tally.add(kinds, counts)
            sums = [[(known == 1).sum(), (known == 0).sum(), len(known), 0, 0]]
            tally.add(np.zeros(1, np.uint64), np.array(sums, np.int32))
            if tally.size > FLUSH:
                yield from tally.take()
    yield from tally.take()


def count_grams(docs: DataFrame) -> DataFrame:
    """(gram, history, word, COUNTS) over all documents of docs (text, y); y is 1, 0 or null."""
    schema = "gram long, " + ", ".join(f"{c} long" for c in COUNTS)
    summed = docs.select("text", "y").mapInArrow(_counting, schema).groupBy("gram")
    return summed.agg(*[F.sum(c).alias(c) for c in COUNTS]).select(
        "gram", F.shiftrightunsigned("gram", 32).alias("history"),
        F.col("gram").bitwiseAND(F.lit(0xFFFFFFFF).cast("long")).alias("word"), *COUNTS,
    )


def _level(count: str, total: Column, d: float, left: Column, lower: Column) -> Column:
    """One Kneser-Ney interpolation: what the discount takes away goes to ``lower``."""
    own = F.greatest(F.col(count) - F.lit(d), F.lit(0.0)) / total
    return F.when(total > 0, own).otherwise(0.0) + left * lower


def _told(counts: DataFrame) -> DataFrame:
    """One row per word, with history null, and the bigrams beyond the cut-off.

    Of a word also the distinct words before it (``contexts``), and of the bigrams that end in it how many one
    and two documents of a class hold. Both kinds read one shuffle: no condition here is on its keys.
    """
    bigram = F.col("history") != 0
    words = counts.groupBy("word").agg(
        *[F.sum(F.when(~bigram, F.col(c)).otherwise(0)).alias(c) for c in COUNTS],
        F.sum(bigram.cast("long")).alias("contexts"),
        *[F.sum((bigram & (F.col(c) == k)).cast("long")).alias(f"{c}_{k}") for c in CLASSES for k in (1, 2)],
    )
    bigrams = counts.filter(F.greatest(*CLASSES) > CUTOFF).select("word", "history", *COUNTS, "gram")
    return bigrams.unionByName(words, allowMissingColumns=True)


def _discount(n1: int | None, n2: int | None) -> float:
    """Ney's estimate, and one half where too little is known for it."""
    return n1 / (n1 + 2 * n2) if n1 and n2 else 0.5


def gram_values(counts: DataFrame) -> DataFrame:
    """(gram, alone, ahead, constant): what a word or bigram adds to the difference.

    ``alone`` is what a word adds as such, and ``ahead`` what it adds as a history of any
    other; of a bigram, ``alone`` is what remains beyond that of its two words. ``constant``
    is what a word below the cut-off adds.
    """
    told, _ = stage(_told(counts), "toxic-counts")
    every = told.filter("history is null")
    sums = every.filter("word = 0").first()
    if sums is None or not (sums.toxic and sums.ordinary):
        return told.limit(0).select("gram", *[F.lit(0.0).alias(c) for c in ("alone", "ahead", "constant")])
    words, bigrams = every.filter("word != 0"), told.filter("history != 0")
    known = words.filter(F.greatest(*CLASSES) > CUTOFF)
    held = [F.sum((F.col(c) == k).cast("long")).alias(f"w_{c}_{k}") for c in CLASSES for k in (1, 2)]
    pairs = [F.sum(f"{c}_{k}").alias(f"{c}_{k}") for c in CLASSES for k in (1, 2)]
    seen = words.agg(F.sum(F.col("contexts") + 1).alias("contexts"), *held, *pairs).first()
    d1 = {c: _discount(seen[f"w_{c}_1"], seen[f"w_{c}_2"]) for c in CLASSES}
    d2 = {c: _discount(seen[f"{c}_1"], seen[f"{c}_2"]) for c in CLASSES}
    over = lambda c, d: F.sum(F.greatest(F.col(c) - F.lit(d), F.lit(0.0)))
    spent = known.agg(*[over(c, d1[c]).alias(c) for c in CLASSES]).first()
    left = {c: 1 - (spent[c] or 0) / sums[c] for c in CLASSES}
    constant = float(np.float32(np.log(left["toxic"]) - np.log(left["ordinary"])))
    backoff = (F.col("contexts") + 1) / F.lit(float(seen.contexts))
    kept = known.select(
        "word", *[F.col(f"after_{c}").alias(f"n_{c}") for c in CLASSES],
        *[_level(c, F.lit(float(sums[c])), d1[c], F.lit(left[c]), backoff).alias(f"p_{c}") for c in CLASSES],
    )
    heads = (
        bigrams.groupBy("history")
        .agg(*[over(c, d2[c]).alias(f"over_{c}") for c in CLASSES])
        .join(kept.withColumnRenamed("word", "history").drop("p_toxic", "p_ordinary"), "history")
    )
    for c in CLASSES:
        share = 1 - F.col(f"over_{c}") / F.col(f"n_{c}")
        heads = heads.withColumn(f"left_{c}", F.when(F.col(f"n_{c}") > 0, share).otherwise(1.0))
    heads = heads.withColumn("ahead", F.log("left_toxic") - F.log("left_ordinary")).drop("over_toxic", "over_ordinary")
    alone = F.log("p_toxic") - F.log("p_ordinary")
    ones = kept.join(heads.select(F.col("history").alias("word"), "ahead"), "word", "left").select(
        F.col("word").alias("gram"), alone.alias("alone"), F.coalesce("ahead", F.lit(0.0)).alias("ahead")
    )
    full = {
        c: _level(c, F.col(f"n_{c}"), d2[c], F.col(f"left_{c}"), F.col(f"p_{c}")) for c in CLASSES
    }
    rest = F.log(full["toxic"]) - F.log(full["ordinary"]) - alone - F.col("ahead")
    twos = (
        bigrams.join(kept.drop("n_toxic", "n_ordinary"), "word")
        .join(heads, "history")
        .select("gram", rest.alias("alone"), F.lit(0.0).alias("ahead"))
    )
    rounded = [F.col(c).cast("float").cast("double").alias(c) for c in ("alone", "ahead")]
    return ones.unionByName(twos).select("gram", *rounded, F.lit(constant).alias("constant"))


class Values:
    """The values of all kept expressions, sorted by gram for look-up."""

    def __init__(self, rows: pa.Table):
        gram = np.ascontiguousarray(rows.column("gram").to_numpy()).view(np.uint64)
        order = np.argsort(gram)
        self.gram = gram[order]
        self.alone = rows.column("alone").to_numpy()[order].astype(np.float32)
        self.ahead = rows.column("ahead").to_numpy()[order].astype(np.float32)
        self.constant = rows.column("constant")[0].as_py() if rows.num_rows else 0.0

    def find(self, gram: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(self.gram):
            return np.zeros(len(gram), int), np.zeros(len(gram), bool)
        at = np.minimum(np.searchsorted(self.gram, gram), len(self.gram) - 1)
        return at, self.gram[at] == gram

    def evidence(self, s: Slice) -> np.ndarray:
        """difference, strong part and number of expressions of each text."""
        x = expressions(s)
        n = len(s)
        at, known = self.find(x.word)
        alone = np.where(known, self.alone[at] if len(self.alone) else 0.0, self.constant)
        # floating also where there is nothing to count
        total = np.bincount(x.word_row, alone, n).astype(np.float64)
        strong = np.bincount(x.word_row, np.where(alone > STRONG, alone, 0), n).astype(np.float64)
        at, known = self.find(x.history)
        total += np.bincount(x.gram_row, np.where(known, self.ahead[at] if len(self.ahead) else 0.0, 0.0), n)
        some = np.flatnonzero(known)  # a kept bigram has a kept history
        at, known = self.find(x.gram[some])
        hit, alone = some[known], self.alone[at[known]]
        total += np.bincount(x.gram_row[hit], alone, n)
        strong += np.bincount(x.gram_row[hit], np.where(alone > STRONG, alone, 0), n)
        return np.column_stack([total, strong, np.bincount(x.word_row, minlength=n).astype(np.float64)])


def _with_evidence(docs: DataFrame, values: DataFrame, rows: int) -> DataFrame:
    """docs with the columns EVIDENCE."""
    if values.count() > rows:
        return _by_join(docs, values)
    table = Values(values.toArrow())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in slices(take_column(batch, "text")):
                found = table.evidence(s)
                part = batch.slice(s.first, len(s))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, *[pa.array(np.ascontiguousarray(c)) for c in found.T]],
                    [*part.schema.names, *EVIDENCE],
                )

    return docs.mapInArrow(run, StructType([*docs.schema.fields, *[StructField(c, DoubleType()) for c in EVIDENCE]]))


def _by_join(docs: DataFrame, values: DataFrame) -> DataFrame:
    """The same by sending each text's distinct expressions to the values."""
    keyed, _ = stage(docs.withColumn("_row", F.monotonically_increasing_id()), "toxic-rows")

    def job(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        ids = take_column(batch, "_row").to_numpy()
        for s in slices(take_column(batch, "text")):
            x = expressions(s)
            # kind 0: a word; 1: the history of a bigram; 2: a bigram
            for kind, (row, gram) in enumerate(
                ((x.word_row, x.word), (x.gram_row, x.history), (x.gram_row, x.gram))
            ):
                yield batch_of(_row=ids[s.first + row], gram=signed(gram), kind=np.full(len(row), kind, np.int64))

    sent = arrow_map(keyed.select("_row", "text"), job, "_row long, gram long, kind long")
    constant = F.lit(float(values.agg(F.max("constant")).first()[0] or 0.0))
    kind = F.col("kind")
    value = F.when(kind == 1, F.coalesce("ahead", F.lit(0.0))).otherwise(
        F.coalesce("alone", F.when(kind == 0, constant).otherwise(0.0))
    )
    sums = (
        sent.join(values.drop("constant"), "gram", "left")
        .groupBy("_row")
        .agg(
            F.sum(value).alias("difference"),
            F.sum(F.when((kind != 1) & (value > STRONG), value).otherwise(0.0)).alias("strong"),
            F.sum((kind == 0).cast("double")).alias("n_expressions"),
        )
    )
    joined = keyed.join(sums, "_row", "left").drop("_row")
    return joined.withColumns({c: F.coalesce(c, F.lit(0.0)) for c in EVIDENCE})


def measures(difference, strong, n, log, sqrt) -> list:
    """What the regression sees; the same formula for columns and for arrays."""
    return [difference / n * 100, difference / sqrt(n), log(n), log(1 + strong), strong / sqrt(n)]


def score_toxicity(
    docs: DataFrame, labels: DataFrame, learn: Column | None = None, model_rows: int = MODEL_ROWS
) -> DataFrame:
    """All columns of docs, then EVIDENCE, held_out, score, predicted."""
    held = F.coalesce(fold(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False))
    known, _ = stage(one_label(labels, "toxic").filter(~held if learn is None else learn), "toxic-labels")
    aside = F.pmod(F.xxhash64("doc_id"), F.lit(5)) == 0
    y = known.select(F.col("doc_id").alias("_id"), F.when(~aside, F.col("y")).alias("y"))
    text = docs.select("doc_id", "text")
    learning = text.join(bounded_broadcast(y), F.col("doc_id") == F.col("_id"), "left")
    values, _ = stage(gram_values(count_grams(learning)), "toxic-values")
    sample = known.filter(aside).orderBy(F.xxhash64("doc_id")).limit(CALIBRATION_ROWS)
    rows = _with_evidence(text.join(F.broadcast(sample), "doc_id"), values, model_rows)
    # ids are few, but rows that share one may be many
    got = rows.orderBy(F.xxhash64("doc_id"), F.xxhash64("text")).limit(CALIBRATION_ROWS).select("y", *EVIDENCE).toArrow()
    y = got.column("y").to_numpy()
    weights = np.zeros(6)
    if len(y) and 0 < y.mean() < 1:
        difference, strong, n = (got.column(c).to_numpy() for c in EVIDENCE)
        weights = fit_logistic(np.column_stack(measures(difference, strong, np.maximum(n, 1), np.log, np.sqrt)), y)
    else:
        share = known.agg(F.avg("y")).first()[0] or 0.0
        weights[-1] = np.log((share + 1e-6) / (1 - share + 1e-6))
    n = F.greatest(F.col("n_expressions"), F.lit(1.0))
    parts = [*measures(F.col("difference"), F.col("strong"), n, F.log, F.sqrt), F.lit(1.0)]
    logit = sum((part * F.lit(float(w)) for part, w in zip(parts, weights, strict=True)), F.lit(0.0))
    plain = docs.drop(*EVIDENCE, "held_out", "score", "predicted")
    scored = _with_evidence(plain, values, model_rows).withColumn("score", 1 / (1 + F.exp(-logit)))
    return scored.select(
        *plain.columns, *EVIDENCE, held.alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
