"""The four dimension builds."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from encore.functions.calendar import calendar_fields, epoch_ms_to_ts


def project(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Columns of ``df`` under new names: target name -> source name."""
    return df.select(*[F.col(source).alias(target) for target, source in mapping.items()])


def distinct_rows(df: DataFrame) -> DataFrame:
    """One of each row; NULL equals NULL, an empty string differs from it."""
    return df.distinct()


def last_event_per_user(events: DataFrame) -> DataFrame:
    """Newest ``ts`` per user; events without a user form one group."""
    return events.groupBy("userid").agg(F.max("ts").alias("last_ts"))


def latest_level_per_user(events: DataFrame) -> DataFrame:
    """The level, or levels on a tie, that each user had at the newest ``ts``.

    Aggregating per (user, level) first leaves a handful of rows per user for
    the window, however many events one user has.
    """
    newest = (
        events.where(F.col("userid").isNotNull() & F.col("ts").isNotNull())
        .groupBy("userid", "level")
        .agg(F.max("ts").alias("last_ts"))
    )
    by_recency = Window.partitionBy("userid").orderBy(F.desc("last_ts"))
    ranked = newest.withColumn("_rank", F.rank().over(by_recency))
    return ranked.where("_rank = 1").drop("_rank")


def build_users(events: DataFrame) -> DataFrame:
    """Each profile a user ever had, with the latest level or levels.

    Two narrow scans, of the profile columns and of level and time, both
    reduced on the map side before they are shuffled, meet in one join. Events
    are never joined with themselves, and no user is gathered in one task: one
    with very many profiles is a skewed join partition, which AQE splits.
    """
    profiles = distinct_rows(
        events.where(F.col("userid").isNotNull()).select("userid", "firstname", "lastname", "gender")
    )
    levels = latest_level_per_user(events).select("userid", "level")
    return project(
        profiles.join(levels, "userid"),
        {
            "user_id": "userid",
            "first_name": "firstname",
            "last_name": "lastname",
            "gender": "gender",
            "level": "level",
        },
    )


def build_artists(songs_raw: DataFrame) -> DataFrame:
    """Distinct on all five columns: an artist with two locations is two rows."""
    return distinct_rows(
        project(
            songs_raw,
            {
                "artist_id": "artist_id",
                "name": "artist_name",
                "location": "artist_location",
                "latitude": "artist_latitude",
                "longitude": "artist_longitude",
            },
        )
    )


def build_songs(songs_raw: DataFrame) -> DataFrame:
    """Distinct songs; year 0 means unknown and stays."""
    return distinct_rows(songs_raw.select("song_id", "title", "artist_id", "year", "duration"))


def build_time(events: DataFrame) -> DataFrame:
    """The calendar of all event times, whatever the page.

    Distinct on the 8-byte epoch value; the fields are computed once per value.
    """
    start = events.select("ts").distinct().select(epoch_ms_to_ts(F.col("ts")).alias("start_time"))
    return start.select("start_time", *calendar_fields(F.col("start_time")))
