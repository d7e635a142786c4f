"""JSON files to typed staging rows.

Keys are matched ignoring case, unknown keys are ignored, missing ones are
NULL. Every value is read as text first and then cast to the declared type, so
that quoted numbers and empty strings load the way the warehouse loads them.
A file is a series of objects, with or without line breaks between them; whatever
else stands there is a malformed record. ``encore.sources.objects`` cuts files into objects.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from encore.functions.text import blank_to_null
from encore.operators.quality import passing
from encore.schemas import STAGING_EVENTS, STAGING_SONGS, Table
from encore.sources.objects import DOCUMENTS, LINES, PLACE, objects

STRICT = "strict"  # the first bad record aborts the load
QUARANTINE = "quarantine"  # bad records are left out; bad_records lists them


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """The JSON objects of all files under ``path`` at any depth, with their place; none goes over a line's end."""
    return objects(spark, path, LINES)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """The same for files whose objects may go over several lines."""
    return objects(spark, path, DOCUMENTS)


def _computed_once(df: DataFrame, **values: Column) -> DataFrame:
    """``df`` with further columns that nothing above computes again.

    Spark copies the expressions of a projection into whatever filters it; those of a generator
    are left alone, so each value is made once per row, however often it is used.
    """
    row = F.struct(*[v.alias(name) for name, v in values.items()])
    return df.select("*", F.inline(F.array(row)))


def bind_json(df: DataFrame, table: Table, value: str = "value") -> DataFrame:
    """``df`` with the columns of ``table``, all as text, from the JSON text in ``value``.

    When keys of one record differ only in case, the last one wins. An unreadable
    record gives NULLs and a true ``_unreadable``. The text is parsed once.
    """
    parsed = _computed_once(df, _fields=F.from_json(value, "map<string,string>", {"mode": "PERMISSIVE"}))
    arrays = parsed.select(
        *df.columns,
        F.col("_fields").isNull().alias("_unreadable"),
        F.reverse(F.transform(F.map_keys("_fields"), F.lower)).alias("_keys"),
        F.reverse(F.map_values("_fields")).alias("_texts"),
    )

    def pick(name: str) -> Column:
        return F.get("_texts", (F.array_position("_keys", name) - 1).cast("int"))

    return _computed_once(arrays, **{c.name: pick(c.name) for c in table.columns}).drop("_keys", "_texts")


def _number(text: Column, kind: T.DataType) -> Column:
    """The text of a number cut toward zero at the scale of ``kind``, if that is a decimal.

    Digits go before the text becomes a number, so nothing is rounded on the way.
    """
    filled = blank_to_null(text)
    if not isinstance(kind, T.DecimalType):
        return filled
    # Most texts have no decimals to lose and no exponent, and go to the cast as they are.
    dot = F.locate(".", filled)
    fits = ((dot == 0) | (F.length(filled) - dot <= kind.scale)) & ~filled.rlike("[eE]")
    digits = F.regexp_replace(filled, rf"^(\s*[+-]?[0-9]*\.[0-9]{{{kind.scale}}})[0-9]+(\s*)$", "$1$2")
    short = F.when(F.length(filled) > 18, digits).otherwise(filled)  # a short text has no more than 18 decimals
    exact = short.try_cast(T.DecimalType(38, 18))  # of a number with an exponent, too
    below = filled.rlike(r"^[^\p{Nd}.]*-")  # by the text, so that the number is made once
    cut = F.when(below, F.ceil(exact, F.lit(kind.scale))).otherwise(F.floor(exact, F.lit(kind.scale)))
    return F.when(fits, filled).otherwise(F.coalesce(cut.cast("string"), filled))


def coerce(df: DataFrame, table: Table) -> DataFrame:
    """Cast the text columns of ``df`` to the types of ``table``; text stays as it is.

    Decimals lose the digits beyond their scale without rounding.
    """

    def cast(name: str, kind: T.DataType) -> Column:
        text = F.col(name)
        if isinstance(kind, T.StringType):
            return text
        return _number(text, kind).cast(kind).alias(name)

    return df.select(*[cast(c.name, c.type) for c in table.columns])


def _typed_name(name: str) -> str:
    return f"_typed_{name}"


def fault(table: Table) -> Column:
    """Why a bound text row does not fit ``table``; NULL for a row that does.

    Refers to the texts and to the values, named by ``_typed_name``, that they give.
    """
    reasons = []
    for c in table.columns:
        text = F.col(c.name)
        if not isinstance(c.type, T.StringType):
            filled = blank_to_null(text)
            reasons.append(F.when(filled.isNotNull() & F.col(_typed_name(c.name)).isNull(), f"type of {c.name}"))
            missing = filled.isNull()
        else:
            missing = text.isNull()
            if c.width is not None:
                reasons.append(F.when(F.octet_length(text) > c.width, f"width of {c.name}"))
        if c.required:
            reasons.append(F.when(missing, f"{c.name} is NULL"))
    return F.coalesce(*reasons)


def _tagged(df: DataFrame, table: Table, value: str) -> DataFrame:
    """``df`` with texts and typed values of ``table`` and the ``_reason`` why a record is bad."""
    bound = bind_json(df, table, value)
    kinds = {c.name: c.type for c in table.columns if not isinstance(c.type, T.StringType)}
    typed = {_typed_name(n): _number(F.col(n), kind).try_cast(kind) for n, kind in kinds.items()}
    reason = F.when(F.col("_unreadable"), "not json").otherwise(fault(table))
    # apart, as code that is made in one piece with that of the values is too long to be compiled
    return _computed_once(_computed_once(bound, **typed), _reason=reason)


def _values(tagged: DataFrame, table: Table) -> DataFrame:
    """The columns of ``table`` from rows without a fault."""
    names = {c.name: c.name if isinstance(c.type, T.StringType) else _typed_name(c.name) for c in table.columns}
    return tagged.select(*[F.col(source).alias(name) for name, source in names.items()])


def bad_records(df: DataFrame, table: Table, value: str = "value") -> DataFrame:
    """The records a strict load would stop at: ``value``, the first ``reason``, and the place if it is known."""
    place = [c for c in PLACE if c in df.columns]
    bad = _tagged(df.select(value, *place), table, value).where(F.col("_reason").isNotNull())
    return bad.select(F.col(value).alias("value"), F.col("_reason").alias("reason"), *place)


def typed_rows(df: DataFrame, table: Table, mode: str = STRICT, counts: Observation | None = None) -> DataFrame:
    """JSON text in ``value`` to rows of ``table``.

    Strict or not, bad records are met in a filter, which runs whatever columns are read. A
    strict load names the file and the line, if ``df`` has them. ``counts`` gets the number of
    records that were ``read`` and of those ``left_out``, from the job that runs the rows.
    """
    if mode not in (STRICT, QUARANTINE):
        raise ValueError(f"unknown load mode {mode!r}")
    place = [c for c in PLACE if c in df.columns]
    tagged = _tagged(df.select("value", *place), table, "value")
    reason = F.col("_reason")
    if counts is not None:
        tagged = tagged.observe(counts, F.count(F.lit(1)).alias("read"), F.count(reason).alias("left_out"))
    if mode == STRICT:
        where = F.concat(F.lit(" in "), "file", F.lit(" from byte "), "from_byte", F.lit(", line "), "line") if place else F.lit("")
        return _values(tagged.where(passing(reason, f"bad record for {table.name}", where)), table)
    return _values(tagged.where(reason.isNull()), table)


def load_events(
    spark: SparkSession, path: str, mode: str = STRICT, counts: Observation | None = None
) -> DataFrame:
    """Event logs: files of JSON lines under ``path``."""
    return typed_rows(read_lines(spark, path), STAGING_EVENTS, mode, counts)


def load_songs(
    spark: SparkSession, path: str, mode: str = STRICT, layout: str = DOCUMENTS, counts: Observation | None = None
) -> DataFrame:
    """Song catalogue under ``path``: objects over any number of lines, or ``LINES``."""
    return typed_rows(objects(spark, path, layout), STAGING_SONGS, mode, counts)
