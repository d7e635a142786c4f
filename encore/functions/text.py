"""Text helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def name_key(name: Column) -> Column:
    """Artist names match exactly except for trailing blanks."""
    return F.rtrim(name)


def blank_to_null(value: Column) -> Column:
    """An empty field holds no number."""
    return F.nullif(value, F.lit(""))
