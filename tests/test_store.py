"""Tables that change all at once, numbers noted beside them, counts and layouts that follow."""

import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from encore.plans.pipeline import APPEND, count_plays_by_month, insert_songplays, run_pipeline, stored_month_counts
from encore.plans.reports import month_counts, top_artists, top_songs
from encore.schemas import TABLES
from encore.sinks import layout
from encore.sinks.layout import lay_out, read_tables
from encore.sinks.store import TableStore

USER = (1, "a", "b", "F", "free")


def users(spark, *ids):
    return spark.createDataFrame([(i, *USER[1:]) for i in ids], TABLES["users"].schema)


def put(folder, *records):
    folder.mkdir()
    (folder / "part.json").write_text("\n".join(json.dumps(r) for r in records))
    return str(folder)


def play(ts, artist="A", user="1"):
    return {"userId": user, "artist": artist, "page": "NextSong", "sessionId": 2, "level": "free", "ts": ts}


JANUARY, MARCH = 1514764800000, 1519862400000


@pytest.fixture
def files(tmp_path):
    songs = [
        {"song_id": f"S{k}", "title": f"T{k}", "artist_id": f"X{k % 2}", "artist_name": "AB"[k % 2], "year": 0} for k in range(6)
    ]
    one = put(tmp_path / "one", play(JANUARY), play(JANUARY), play(JANUARY + 1, "B"), play(MARCH))
    two = put(tmp_path / "two", play(JANUARY), play(MARCH, "B"), play(MARCH + 5), play(MARCH + 5, "B"))
    return one, two, put(tmp_path / "songs", *songs)


def test_changes_are_seen_together_or_not_at_all(spark, tmp_path):
    store, other = (TableStore(spark, str(tmp_path)) for _ in range(2))
    store.create_missing()
    with store.change():
        store.append("users", users(spark, 1))
        store.append("users", users(spark, 2))
        assert store.read("users").count() == 2 and other.read("users").count() == 0
    assert other.read("users").count() == 2
    with pytest.raises(KeyError):
        with store.change():
            store.rebuild()
            raise KeyError
    assert rows(store.read("users"), "user_id") == [(1,), (2,)]


def test_of_two_changes_at_once_the_second_fails(spark, tmp_path):
    store, other = (TableStore(spark, str(tmp_path)) for _ in range(2))
    store.create_missing()
    with pytest.raises(Exception, match="already exists"):
        with store.change():
            store.append("users", users(spark, 1))
            other.append("users", users(spark, 2))
    assert rows(store.read("users"), "user_id") == [(2,)]


def test_part_of_a_manifest_is_none(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    store.create_missing()
    store.append("users", users(spark, 1))
    (tmp_path / "_manifests" / "000000000007.json").write_text('{"tables": {"us')
    assert store.read("users").count() == 1
    store.append("users", users(spark, 2))
    assert store.read("users").count() == 2 and (tmp_path / "_manifests" / "000000000008.json").exists()


def test_unknown_tables_and_empty_ones(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    with pytest.raises(ValueError, match="has no table users"):
        store.read("users")
    store.create_missing()
    assert store.read("users").count() == 0 and store.read("users").schema == TABLES["users"].schema


def test_compaction_and_vacuum(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    store.create_missing()
    for k in range(3):
        store.append("users", users(spark, k))
    store.take_note("users", last=2)
    store.compact("users")
    assert rows(store.read("users"), "user_id") == [(0,), (1,), (2,)]
    assert len(store.parts("users")) == 1 and store.note("users") == {"last": 2}
    assert len(store.vacuum()) == 4 and store.vacuum() == []
    assert store.read("users").count() == 3
    store.append("users", users(spark, 9))
    assert store.note("users") == {}, "a note holds until the rows change"


def test_ids_go_on_without_reading_the_fact(spark, files, tmp_path, monkeypatch):
    one, _, songs = files
    store = run_pipeline(spark, one, songs, str(tmp_path / "out"))
    assert store.note("songplays") == {"last_id": 11}
    read = []
    whole = TableStore.read
    monkeypatch.setattr(TableStore, "read", lambda self, name, parts=None: read.append((name, parts)) or whole(self, name, parts))
    insert_songplays(store)
    assert ("songplays", None) not in read
    monkeypatch.undo()
    ids = [r[0] for r in rows(store.read("songplays"), "songplay_id")]
    assert ids == list(range(24)) and store.note("songplays") == {"last_id": 23}
    store.append("songplays", store.read("songplays").where("songplay_id = 23").withColumn("songplay_id", F.lit(40)))
    insert_songplays(store)  # without a note it looks
    assert rows(store.read("songplays").agg(F.max("songplay_id"))) == [(52,)]


def test_stored_counts_equal_plain_ones_after_appends(spark, files, tmp_path):
    one, two, songs = files
    out = str(tmp_path / "out")
    store = run_pipeline(spark, one, songs, out)
    for logs in (None, two, one):
        if logs:
            run_pipeline(spark, logs, songs, out, APPEND)
        plain = month_counts(store.read("songplays"), store.read("time"))
        assert rows(stored_month_counts(store)) == rows(plain.select("song_id", "artist_id", "month", "year", "plays"))
        tables = [store.read(n) for n in ("songplays", "songs", "artists", "time")]
        fact, sung, artists, time = tables
        assert rows(top_songs(*tables, 2018, 100, stored_month_counts(store))) == rows(top_songs(*tables, 2018, 100))
        assert rows(top_artists(fact, artists, time, 2018, 9, stored_month_counts(store))) == rows(
            top_artists(fact, artists, time, 2018, 9)
        )
        assert top_songs(*tables, 2017, 9, stored_month_counts(store)).count() == 0
    store.compact("songplays"), store.compact("time"), store.compact("plays_by_month")
    assert rows(stored_month_counts(store)) == rows(plain.select("song_id", "artist_id", "month", "year", "plays"))
    store.append("time", store.read("time").limit(1))
    assert stored_month_counts(store) is None, "a calendar that others changed"
    count_plays_by_month(store)
    plain = month_counts(store.read("songplays"), store.read("time"))
    assert rows(stored_month_counts(store)) == rows(plain.select("song_id", "artist_id", "month", "year", "plays"))


def test_reports_on_stored_counts_do_not_read_the_fact(spark, files, tmp_path):
    one, _, songs = files
    store = run_pipeline(spark, one, songs, str(tmp_path / "out"))
    tables = [store.read(n) for n in ("songplays", "songs", "artists", "time")]
    plan = top_songs(*tables, 2018, 5, stored_month_counts(store))._jdf.queryExecution().optimizedPlan().toString()
    assert "start_time" not in plan and "user_agent" not in plan and "plays#" in plan


def test_layouts_follow_inserts(spark, files, tmp_path, monkeypatch):
    one, two, songs = files
    out = str(tmp_path / "out")
    store = run_pipeline(spark, one, songs, out)
    lay_out(store, 2, "follow")
    name = "follow.songplays"

    def reports(database):
        found = read_tables(store, database)
        fact, sung, artists, time = (found[n] for n in ("songplays", "songs", "artists", "time"))
        return rows(top_songs(fact, sung, artists, time, 2018, 99)), rows(top_artists(fact, artists, time, 2018, 9))

    def laid_out():
        plan = read_tables(store, "follow")["songplays"]._jdf.queryExecution().executedPlan().toString()
        return "follow.songplays" in plan

    assert laid_out() and reports("follow") == reports(None)
    run_pipeline(spark, two, songs, out, APPEND)
    assert not laid_out() and reports("follow") == reports(None), "a layout that lacks rows is not read"
    wrote = []
    write = layout.write_layout
    monkeypatch.setattr(layout, "write_layout", lambda *a: wrote.append((a[1], a[6:])) or write(*a))
    lay_out(store, 2, "follow")
    assert laid_out() and reports("follow") == reports(None)
    assert {a for _, a in wrote} == {("append",)}, "only new inserts are written"
    lay_out(store, 2, "follow")
    assert len(wrote) == 3, "nothing to do"
    layout._set_properties(spark, name, {layout.UNFINISHED: "yes"})
    assert not laid_out() and reports("follow") == reports(None)
    lay_out(store, 2, "follow")
    assert laid_out() and wrote[-1] == (name, ()) and reports("follow") == reports(None)
    run_pipeline(spark, two, songs, out)
    assert not laid_out() and reports("follow") == reports(None), "the rows it holds are gone"
    lay_out(store, 4, "follow")
    assert laid_out() and reports("follow") == reports(None)


def test_a_run_tells_what_it_left_out(spark, files, tmp_path):
    one, _, songs = files
    bad = put(tmp_path / "bad", play(JANUARY), {"ts": "x"}, play(MARCH))
    told = []
    run_pipeline(spark, bad, songs, str(tmp_path / "out"), on_bad_record="quarantine", told=told.append)
    assert told == [{"staging_events": {"read": 3, "left_out": 1}, "staging_songs": {"read": 6, "left_out": 0}}]
