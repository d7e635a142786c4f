"""Rewritten jobs against the plain form of the same question, on random rows."""

import random

import pytest
from conftest import rows

from encore.operators.dimensions import (
    build_artists,
    build_songs,
    build_time,
    build_users,
    latest_level_per_user,
)
from encore.operators.facts import build_songplays
from encore.plans.reports import (
    artist_plays,
    count_plays,
    in_year,
    plays_per_artist,
    plays_per_song_month,
    star_join,
    with_time,
)
from pyspark.sql import functions as F

YEAR_MS = 365 * 86_400_000


@pytest.fixture(params=[1, 2])
def tables(request, make_events, make_songs):
    """Many ties, NULLs, repeated rows and one hot user and artist."""
    draw = random.Random(request.param)

    def hot(values):
        return values[0] if draw.random() < 0.4 else draw.choice(values)

    events = make_events(
        *[
            {
                "userid": hot([1, 2, 3, 4, None]),
                "firstname": draw.choice(["Ann", "Anna", None]),
                "level": draw.choice(["free", "paid", None]),
                "ts": hot([0, 1, YEAR_MS, YEAR_MS + 1, 2 * YEAR_MS, None]),
                "artist": hot(["A", "A ", "B", "C", "nobody", None]),
                "page": draw.choice(["NextSong", "Home"]),
            }
            for _ in range(120)
        ]
    )
    catalogue = make_songs(
        *[
            {
                "artist_id": hot(["A1", "A2", "A3"]),
                "artist_name": draw.choice(["A", "B", "C", None]),
                "artist_location": draw.choice(["", "X", None]),
                "song_id": draw.choice(["S1", "S2", "S3", "S4"]),
                "title": draw.choice(["T", "U"]),
            }
            for _ in range(25)
        ]
    )
    return events, catalogue


def test_users(tables):
    events, _ = tables
    newest = events.groupBy(F.col("userid").alias("nu")).agg(F.max("ts").alias("nt"))
    levels = events.select(F.col("userid").alias("lu"), F.col("ts").alias("lt"), F.col("level").alias("ll"))
    at_newest = newest.join(levels, (F.col("nu") == F.col("lu")) & (F.col("nt") == F.col("lt")))
    plain = (
        events.join(at_newest, F.col("userid") == F.col("nu"))
        .select("userid", "firstname", "lastname", "gender", "ll")
        .distinct()
    )
    assert rows(build_users(events)) == rows(plain)
    assert rows(latest_level_per_user(events)) == rows(at_newest.select("nu", "ll", "nt").distinct())


def test_counts(tables):
    events, catalogue = tables
    artists, songs, time = build_artists(catalogue), build_songs(catalogue), build_time(events)
    # A dimension inserted twice multiplies plays too.
    songs, time = songs.union(songs.limit(1)), time.union(time)
    fact = build_songplays(events, artists, songs).withColumn("songplay_id", F.lit(1))
    star = star_join(fact, songs, artists, time)
    by_month = ["sp.song_id", "sn.title", "sp.artist_id", "art.name", "tm.month", "tm.year"]
    plain = count_plays(star, by_month)
    found = plays_per_song_month(fact, songs, artists, time)
    assert rows(found) == rows(plain) and plain.count() > 10
    in_1971 = plays_per_song_month(fact, songs, artists, time, 1971)
    assert rows(in_1971) == rows(in_year(plain, 1971))

    by_artist = ["art.artist_id", "art.name"]
    plain = count_plays(with_time(artist_plays(artists, fact), time), by_artist)
    assert rows(plays_per_artist(fact, artists, time)) == rows(plain)
