"""Declared constraints as data-quality jobs.

Counts never move whole rows: each check reduces its input with map-side
partial aggregation before anything is shuffled, so one hot key is one row per
task on the wire.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from encore.schemas import TABLES, Table


def _count_per_column(df: DataFrame, faults: dict[str, Column]) -> DataFrame:
    """One pass over ``df``; a row (column_name, violations) per entry of ``faults``."""
    totals = df.select(*[F.count_if(bad).alias(name) for name, bad in faults.items()])
    pairs = F.array(
        *[
            F.struct(F.lit(name).alias("column_name"), F.col(name).alias("violations"))
            for name in faults
        ]
    )
    return totals.select(F.inline(pairs))


def not_null_violations(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """NULLs per required column."""
    return _count_per_column(df, {c: F.col(c).isNull() for c in columns})


def width_violations(df: DataFrame, widths: dict[str, int]) -> DataFrame:
    """Strings longer than the allowed number of bytes, per column."""
    return _count_per_column(df, {c: F.octet_length(c) > n for c, n in widths.items()})


def key_violations(df: DataFrame, keys: Iterable[str]) -> DataFrame:
    """Key values held by more than one row, with the number of ``copies``."""
    return df.groupBy(*keys).agg(F.count("*").alias("copies")).where("copies > 1")


def fk_violations(child: DataFrame, parent: DataFrame, on: dict[str, str]) -> DataFrame:
    """One row: child rows whose key (child column -> parent column) has no parent.

    A NULL key refers to nothing and is no violation. Child keys are counted
    before the join, so a hot key reaches it as a single row.
    """
    keys = (
        child.dropna(subset=list(on))
        .groupBy(*[F.col(c).alias(f"_child_{c}") for c in on])
        .agg(F.count("*").alias("_rows"))
    )
    matches = reduce(
        lambda a, b: a & b, [F.col(f"_child_{c}") == F.col(f"_parent_{p}") for c, p in on.items()]
    )
    known = parent.select(*[F.col(p).alias(f"_parent_{p}") for p in on.values()])
    orphans = keys.join(known, matches, "left_anti")
    return orphans.agg(F.coalesce(F.sum("_rows"), F.lit(0)).cast("long").alias("violations"))


def reference_violations(table: Table, tables: dict[str, DataFrame]) -> DataFrame:
    """``fk_violations`` of every declared reference of ``table``."""
    counted = [
        fk_violations(tables[table.name], tables[r.table], {r.column: r.target}).select(
            F.lit(table.name).alias("table_name"),
            F.lit(r.column).alias("column_name"),
            F.lit(r.table).alias("parent_name"),
            "violations",
        )
        for r in table.references
    ]
    return reduce(DataFrame.unionAll, counted)


def passing(reason: Column, what: str, where: Column | None = None) -> Column:
    """A filter that is true where ``reason`` is NULL and fails the job, naming it and ``where``, elsewhere.

    As a filter it runs even if the checked columns are not read.
    """
    place = F.lit("") if where is None else F.coalesce(where, F.lit(""))
    stop = F.raise_error(F.concat(F.lit(f"{what}: "), reason, place)).cast("boolean")
    return F.when(reason.isNotNull(), stop).otherwise(True)


def enforce(df: DataFrame, table: Table) -> DataFrame:
    """``df`` as is; running it fails on a NULL in a required column or an overlong string.

    The check rides along with the job that writes the rows: no extra pass, and
    a failed job commits nothing.
    """
    reasons = [F.lit(None).cast("string")]
    for c in table.columns:
        if c.name not in df.columns:
            continue
        if c.required:
            reasons.append(F.when(F.col(c.name).isNull(), f"{table.name}.{c.name} must not be NULL"))
        if c.width is not None:
            reasons.append(F.when(F.octet_length(c.name) > c.width, f"{table.name}.{c.name} takes at most {c.width} bytes"))
    return df.where(passing(F.coalesce(*reasons), "constraint"))


def _row_checks(df: DataFrame, table: Table) -> DataFrame:
    """Both checks that look at single rows, in one pass."""
    faults = [("not null", c, F.col(c).isNull()) for c in table.required]
    faults += [("width", c, F.octet_length(c) > n) for c, n in table.widths.items()]
    totals = df.select(*[F.count_if(bad).alias(str(k)) for k, (_, _, bad) in enumerate(faults)])
    rows = [
        F.struct(
            F.lit(check).alias("check_name"), F.lit(table.name).alias("table_name"),
            F.lit(column).alias("column_name"), F.col(str(k)).alias("violations"),
        )
        for k, (check, column, _) in enumerate(faults)
    ]
    return totals.select(F.inline(F.array(*rows)))


def check_all(tables: dict[str, DataFrame]) -> DataFrame:
    """Every declared constraint of the stored tables given: (check, table, column, violations).

    ``key`` counts the key values held by more than one row.
    """
    found = []

    def add(check: str, table: Table, counts: DataFrame) -> None:
        found.append(
            counts.select(
                F.lit(check).alias("check_name"),
                F.lit(table.name).alias("table_name"),
                "column_name",
                "violations",
            )
        )

    for name, df in tables.items():
        table = TABLES[name]
        if table.required or table.widths:
            found.append(_row_checks(df, table))
        if table.key:
            repeated = key_violations(df, [table.key]).agg(F.count("*").alias("violations"))
            add("key", table, repeated.withColumn("column_name", F.lit(table.key)))
        if table.references and all(r.table in tables for r in table.references):
            add("reference", table, reference_violations(table, tables))
    return reduce(DataFrame.unionAll, found)
