"""Joins of the star schema and the play-count reports on it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from encore.functions.calendar import year_range


def with_song(fact: DataFrame, songs: DataFrame) -> DataFrame:
    """Fact rows (alias ``sp``) with their song (alias ``sn``)."""
    return fact.alias("sp").join(songs.alias("sn"), F.col("sp.song_id") == F.col("sn.song_id"))


def with_time(plays: DataFrame, time: DataFrame) -> DataFrame:
    """Adds the calendar row (alias ``tm``) of the start time of ``sp``."""
    return plays.join(time.alias("tm"), F.col("sp.start_time") == F.col("tm.start_time"))


def star_join(
    fact: DataFrame, songs: DataFrame, artists: DataFrame, time: DataFrame
) -> DataFrame:
    """Fact rows with all their dimension rows, unfolded.

    The fact meets the calendar first, and then songs that were joined with their artists
    before, so it is never shuffled after the variants of an artist have multiplied it.
    """
    catalogue = songs.alias("sn").join(artists.alias("art"), F.col("sn.artist_id") == F.col("art.artist_id"))
    dated = with_time(fact.alias("sp"), time)
    return dated.join(catalogue, F.col("sp.song_id") == F.col("sn.song_id"))


def artist_plays(artists: DataFrame, fact: DataFrame) -> DataFrame:
    """Artist rows (alias ``art``) with the fact rows (alias ``sp``) of their id."""
    return artists.alias("art").join(
        fact.alias("sp"), F.col("art.artist_id") == F.col("sp.artist_id")
    )


def in_year(df: DataFrame, year: int, column: str = "year") -> DataFrame:
    return df.where(F.col(column) == year)


def count_plays(df: DataFrame, by: Sequence[str | Column], counted: str = "songplay_id") -> DataFrame:
    """Rows with a non-null ``counted`` per group, as ``plays``."""
    return df.groupBy(*by).agg(F.count(counted).alias("plays"))


def top_k(df: DataFrame, by: str, k: int, tie_break: Sequence[str]) -> DataFrame:
    """The ``k`` rows with the largest ``by``; ties go to the smallest ``tie_break``."""
    return df.orderBy(F.desc(by), *tie_break).limit(k)


def _with_calendar(plays: DataFrame, time: DataFrame | None, year: int | None) -> DataFrame:
    """``plays`` with month and year of their start time.

    Fact and calendar are pruned by the same range of start times, which reads
    only the files of that year when the fact is stored sorted. Without a
    calendar the fields are computed, which is the same as long as the key of
    ``time`` and the reference to it hold.
    """
    start = F.col("start_time")
    if year is not None:
        plays = plays.where(year_range(start, year))
    if time is None:
        dated = plays.where(start.isNotNull())
        return dated.withColumns({"month": F.month(start), "year": F.year(start)})
    calendar = time.select("start_time", "month", "year")
    if year is not None:
        calendar = in_year(calendar, year)
    return plays.join(calendar, "start_time")


def month_counts(fact: DataFrame, time: DataFrame | None, year: int | None = None) -> DataFrame:
    """Rows of the fact joined with its calendar, as ``plays`` per song, artist, month and year.

    Counts of parts of the fact add up, and so do those of parts of the calendar. ``time`` may
    be None to compute the calendar instead of joining it; see ``_with_calendar``.
    """
    dated = _with_calendar(fact.select("start_time", "song_id", "artist_id"), time, year)
    return dated.groupBy("song_id", "artist_id", "month", "year").agg(F.count("*").alias("plays"))


def plays_per_song_month(
    fact: DataFrame,
    songs: DataFrame,
    artists: DataFrame,
    time: DataFrame | None,
    year: int | None = None,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Rows of the star join per song, fact artist, artist name, month and year.

    Songs with several rows and artists with several rows multiply the count,
    as in the plain join. Here they multiply one number per song and month and
    not the fact rows. ``counted`` may be the ready ``month_counts`` of the whole fact.
    """
    counted = month_counts(fact, time, year) if counted is None else counted
    if year is not None:
        counted = in_year(counted, year)
    titles = songs.groupBy("song_id", "title", F.col("artist_id").alias("_song_artist")).agg(
        F.count("*").alias("_song_rows")
    )
    names = artists.groupBy(F.col("artist_id").alias("_song_artist"), "name").agg(
        F.count("*").alias("_artist_rows")
    )
    plays = F.sum(F.col("_plays") * F.col("_song_rows") * F.col("_artist_rows"))
    return (
        counted.withColumnRenamed("plays", "_plays")
        .join(titles, "song_id")
        .join(names, "_song_artist")
        .groupBy("song_id", "title", "artist_id", "name", "month", "year")
        .agg(plays.alias("plays"))
    )


def plays_per_artist(
    fact: DataFrame,
    artists: DataFrame,
    time: DataFrame | None,
    year: int | None = None,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Rows of artists joined with the fact, per artist id and name.

    One play is a fact row per song of its artist. These fold into one row on
    the map side, before the join with the calendar shuffles them. ``counted`` may be
    the ready ``month_counts`` of the whole fact.
    """
    if counted is None:
        folded = fact.groupBy("artist_id", "start_time").agg(F.count("*").alias("_rows"))
        dated = _with_calendar(folded, time, year)
    else:
        dated = (counted if year is None else in_year(counted, year)).withColumnRenamed("plays", "_rows")
    counted = dated.groupBy("artist_id").agg(F.sum("_rows").alias("_plays"))
    names = artists.groupBy("artist_id", "name").agg(F.count("*").alias("_artist_rows"))
    plays = F.sum(F.col("_plays") * F.col("_artist_rows"))
    return counted.join(names, "artist_id").groupBy("artist_id", "name").agg(plays.alias("plays"))


def top_songs(
    fact: DataFrame,
    songs: DataFrame,
    artists: DataFrame,
    time: DataFrame | None,
    year: int,
    k: int = 5,
    counted: DataFrame | None = None,
) -> DataFrame:
    """The most played songs of a year, each month on its own."""
    plays = plays_per_song_month(fact, songs, artists, time, year, counted)
    return top_k(plays, "plays", k, ["song_id", "month", "artist_id", "title", "name"])


def top_artists(
    fact: DataFrame,
    artists: DataFrame,
    time: DataFrame | None,
    year: int,
    k: int = 5,
    counted: DataFrame | None = None,
) -> DataFrame:
    """The most played artists of a year."""
    plays = plays_per_artist(fact, artists, time, year, counted)
    return top_k(plays, "plays", k, ["artist_id", "name"])
