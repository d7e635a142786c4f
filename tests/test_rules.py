"""The result rules that are easy to get wrong, on hand-made rows."""

from datetime import datetime

import pytest
from conftest import rows

from encore.functions.calendar import calendar_fields, epoch_ms_to_ts
from encore.operators.dimensions import (
    build_artists,
    build_songs,
    build_time,
    build_users,
    last_event_per_user,
    latest_level_per_user,
)
from encore.operators.facts import build_songplays
from encore.plans.reports import plays_per_artist, plays_per_song_month, top_artists, top_songs
from pyspark.sql import functions as F

JAN, FEB = 1546300800000, 1548979200000  # 2019-01-01, 2019-02-01


def star(events, songs_raw):
    artists, songs = build_artists(songs_raw), build_songs(songs_raw)
    return build_songplays(events, artists, songs), songs, artists, build_time(events)


def test_one_play_counts_for_every_song_of_the_artist(make_events, make_songs):
    catalogue = make_songs(*[{"song_id": s, "title": s} for s in ("S1", "S2", "S3")])
    fact, *_ = star(make_events({"song": "S1"}), catalogue)
    assert rows(fact, "song_id") == [("S1",), ("S2",), ("S3",)]


def test_artist_rows_multiply_plays_twice(make_events, make_songs):
    catalogue = make_songs({"artist_location": "X"}, {"artist_location": "Y"})
    fact, songs, artists, time = star(make_events({"ts": JAN}), catalogue)
    assert artists.count() == 2 and fact.count() == 2
    assert top_artists(fact, artists, time, 2019).first()["plays"] == 4
    assert top_songs(fact, songs, artists, time, 2019).first()["plays"] == 4


def test_song_rows_multiply_plays_twice(make_events, make_songs):
    catalogue = make_songs({"title": "X"}, {"title": "Y"})
    fact, songs, artists, time = star(make_events({"ts": JAN}), catalogue)
    assert fact.count() == 2
    found = rows(top_songs(fact, songs, artists, time, 2019), "title", "plays")
    assert found == [("X", 2), ("Y", 2)]


def test_levels_tied_on_the_newest_time_are_all_kept(make_events):
    events = make_events(
        {"ts": 10, "level": "free"}, {"ts": 20, "level": "paid"}, {"ts": 20, "level": "free"}
    )
    assert rows(build_users(events), "user_id", "level") == [(1, "free"), (1, "paid")]
    assert rows(latest_level_per_user(events)) == [(1, "free", 20), (1, "paid", 20)]


def test_names_come_from_all_events_and_level_from_the_newest(make_events):
    events = make_events(
        {"firstname": "Ann", "ts": 10, "level": "free"},
        {"firstname": "Anna", "ts": 20, "level": "paid"},
    )
    assert rows(build_users(events), "first_name", "level") == [("Ann", "paid"), ("Anna", "paid")]


def test_newest_level_may_be_null(make_events):
    events = make_events({"ts": 10, "level": "free"}, {"ts": 20, "level": None})
    assert rows(build_users(events), "user_id", "level") == [(1, None)]
    assert rows(latest_level_per_user(events)) == [(1, None, 20)]


def test_user_without_any_time_is_no_user(make_events):
    events = make_events({"userid": 1, "ts": None}, {"userid": 2}, {"userid": 2, "ts": None})
    assert rows(build_users(events), "user_id") == [(2,)]
    assert rows(latest_level_per_user(events), "userid") == [(2,)]


def test_event_without_user_counts_for_time_only(make_events):
    events = make_events({"userid": None, "page": "Home", "ts": 0})
    assert build_users(events).count() == 0
    assert rows(build_time(events), "start_time") == [(datetime(1970, 1, 1),)]
    assert rows(last_event_per_user(events)) == [(None, 0)]


def test_pages_other_than_nextsong_make_users_but_no_plays(make_events, make_songs):
    events = make_events({"userid": 1}, {"userid": 2, "page": "Home", "ts": 30})
    fact, *_, time = star(events, make_songs({}))
    assert rows(build_users(events), "user_id") == [(1,), (2,)]
    assert rows(fact, "user_id") == [(1,)]
    assert time.count() == 2


def test_play_keeps_the_level_it_was_made_at(make_events, make_songs):
    events = make_events({"ts": 10}, {"ts": 20, "level": "paid", "page": "Home"})
    fact, *_ = star(events, make_songs({}))
    assert rows(fact, "level") == [("free",)]
    assert rows(build_users(events), "level") == [("paid",)]


def test_top_songs_lists_a_song_once_per_month(make_events, make_songs):
    fact, songs, artists, time = star(make_events({"ts": JAN}, {"ts": FEB}), make_songs({}))
    found = rows(top_songs(fact, songs, artists, time, 2019), "song_id", "month", "plays")
    assert found == [("S1", 1, 1), ("S1", 2, 1)]


def test_ties_go_to_the_smallest_ids(make_events, make_songs):
    catalogue = make_songs(*[{"song_id": f"S{i}"} for i in (6, 3, 1, 5, 2, 4)])
    fact, songs, artists, time = star(make_events({"ts": JAN}), catalogue)
    found = top_songs(fact, songs, artists, time, 2019).collect()
    assert [r["song_id"] for r in found] == ["S1", "S2", "S3", "S4", "S5"]


def test_only_the_asked_year_counts(make_events, make_songs):
    fact, songs, artists, time = star(make_events({"ts": JAN - 1}, {"ts": JAN}), make_songs({}))
    assert top_artists(fact, artists, time, 2019).first()["plays"] == 1
    assert top_artists(fact, artists, time, 2018).first()["plays"] == 1
    assert top_artists(fact, artists, time, 2017).count() == 0
    assert plays_per_artist(fact, artists, time).first()["plays"] == 2
    assert plays_per_song_month(fact, songs, artists, time).count() == 2


def test_computed_calendar_gives_the_same_reports(make_events, make_songs):
    events = make_events({"ts": JAN - 1}, {"ts": JAN}, {"ts": FEB}, {"ts": FEB + 1})
    fact, songs, artists, time = star(events, make_songs({}, {"song_id": "S2"}))
    joined = plays_per_song_month(fact, songs, artists, time)
    assert rows(plays_per_song_month(fact, songs, artists, None)) == rows(joined)
    top = top_artists(fact, artists, None, 2019)
    assert rows(top) == rows(top_artists(fact, artists, time, 2019)) == [("A1", "A", 6)]


@pytest.mark.parametrize(
    "moment, hour, week, month, year, weekday",
    [
        ("2018-11-04 23:00:00", 23, 44, 11, 2018, 0),
        ("2018-12-31 00:00:00", 0, 1, 12, 2018, 1),
        ("2021-01-01 12:00:00", 12, 53, 1, 2021, 5),
    ],
)
def test_calendar(spark, moment, hour, week, month, year, weekday):
    at = F.expr(f"timestamp_ntz'{moment}'")
    got = spark.range(1).select(*calendar_fields(at)).first().asDict()
    assert got.pop("day") == int(moment[8:10])
    assert got == dict(hour=hour, week=week, month=month, year=year, weekday=weekday)


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_times_do_not_depend_on_the_session_zone(spark, make_events, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        moment = spark.range(1).select(epoch_ms_to_ts(F.lit(1525132799500)).alias("t")).first()["t"]
        fields = build_time(make_events({"ts": 1525132799500})).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert moment == fields["start_time"] == datetime(2018, 4, 30, 23, 59, 59, 500000)
    assert (fields["hour"], fields["day"], fields["weekday"]) == (23, 30, 1)


def test_empty_and_missing_location_are_different_artists(make_songs):
    catalogue = make_songs({"artist_location": ""}, {"artist_location": None})
    assert rows(build_artists(catalogue), "location") == [(None,), ("",)]


def test_artist_names_match_up_to_trailing_blanks(make_events, make_songs):
    events = make_events({"artist": "abba"}, {"artist": "ABBA "}, {"artist": None})
    catalogue = make_songs({"artist_name": "ABBA"}, {"artist_name": None, "artist_id": "A2"})
    fact, *_ = star(events, catalogue)
    assert rows(fact, "artist_id") == [("A1",)]


def test_unknown_year_stays(make_songs):
    assert rows(build_songs(make_songs({"year": 0})), "year") == [(0,)]
