"""Timestamps without a zone and the calendar parts taken from them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PARTS = ["hour", "day", "week", "month", "year", "weekday"]


def epoch_ms_to_ts(ms: Column) -> Column:
    """Epoch milliseconds to a zone-free timestamp.

    Interval arithmetic on ``timestamp_ntz`` never looks at the session time
    zone, unlike ``timestamp_millis`` followed by a cast.
    """
    epoch = F.expr("timestamp_ntz'1970-01-01 00:00:00'")
    return epoch + ms * F.expr("interval '0.001' second")


def weekday_sun0(ts: Column) -> Column:
    """0 = Sunday .. 6 = Saturday."""
    return F.dayofweek(ts) - 1


def calendar_fields(ts: Column) -> list[Column]:
    """Hour, day, ISO week, month, calendar year and weekday of ``ts``."""
    return [
        F.hour(ts).alias("hour"),
        F.dayofmonth(ts).alias("day"),
        F.weekofyear(ts).alias("week"),
        F.month(ts).alias("month"),
        F.year(ts).alias("year"),
        weekday_sun0(ts).alias("weekday"),
    ]


def year_range(ts: Column, year: int) -> Column:
    """``year(ts) = year`` as a range, which prunes files sorted by ``ts``."""
    start = F.expr(f"timestamp_ntz'{year:04d}-01-01 00:00:00'")
    end = F.expr(f"timestamp_ntz'{year + 1:04d}-01-01 00:00:00'")
    return (ts >= start) & (ts < end)
