"""The whole job on files derived from the test tables."""

import pytest
from compare import assert_same
from conftest import rows

from encore.operators.facts import build_songplays
from encore.operators.quality import check_all
from encore.plans import oracle
from encore.plans.pipeline import APPEND, run_pipeline
from encore.plans.reports import top_artists, top_songs
from encore.schemas import TABLES
from encore.sinks.store import TableStore, by_name, by_position
from encore.sources import crosswalk
from encore.sources.loaders import LINES
from pyspark.sql import functions as F

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def files(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("files")
    crosswalk.write_logs(spark, SF_DIR, f"{root}/logs")
    crosswalk.write_catalogue(spark, SF_DIR, f"{root}/songs")
    return f"{root}/logs", f"{root}/songs"


def counts(store):
    return {name: store.read(name).count() for name in TABLES}


def test_tables_reports_and_reruns(spark, files, tmp_path):
    out = str(tmp_path / "tables")
    store = run_pipeline(spark, *files, out, songs_format=LINES)
    expected = {
        "staging_events": 1000, "staging_songs": 6000, "users": 15, "artists": 17,
        "songs": 200, "time": 531, "songplays": 340,
    }
    assert counts(store) == expected
    sql = oracle.oracle_sql()
    for name, query in {"staging_events": "load_events", "staging_songs": "load_songs",
                        "users": "users", "artists": "artists", "songs": "songs",
                        "time": "time_dim", "songplays": "songplays_with_id"}.items():
        assert_same(store.read(name), SF_DIR, sql[query])
        assert store.read(name).schema == TABLES[name].schema

    fact, artists, songs, time = map(store.read, ("songplays", "artists", "songs", "time"))
    assert_same(top_artists(fact, artists, time, 2024), SF_DIR, sql["top_artists"])
    assert_same(top_songs(fact, songs, artists, time, 2024), SF_DIR, sql["top_songs"])
    assert fact.join(time, "start_time", "left_anti").count() == 0

    checks = {r[:3]: r[3] for r in rows(check_all({n: store.read(n) for n in TABLES}))}
    broken = {k: v for k, v in checks.items() if v}
    assert broken == {("key", "artists", "artist_id"): 7}

    first = rows(fact)
    assert rows(run_pipeline(spark, *files, out, songs_format=LINES).read("songplays")) == first
    again = counts(run_pipeline(spark, *files, out, mode=APPEND, songs_format=LINES))
    assert again["staging_events"] == 2000 and again["staging_songs"] == 12000
    assert all(again[n] == 2 * expected[n] for n in ("users", "artists", "songs", "time"))
    # Twice the events meet twice the artists and twice the songs.
    assert again["songplays"] == 340 + 8 * 340
    ids = store.read("songplays").agg(F.countDistinct("songplay_id"), F.max("songplay_id")).first()
    assert ids == (9 * 340, 9 * 340 - 1)


def test_play_without_user_aborts_the_run(spark, tmp_path):
    """All tables change together: those of the run before stay, and nothing of this one is left."""
    logs, songs = tmp_path / "logs", tmp_path / "songs"
    logs.mkdir(), songs.mkdir()
    (logs / "a.json").write_text(
        '{"userId": "", "artist": "A", "page": "NextSong", "ts": 5, "sessionId": 1}\n'
        '{"userId": "1", "artist": "A", "page": "Home", "ts": 6, "sessionId": 1}\n'
    )
    (songs / "a.json").write_text('{"song_id": "S", "title": "T", "artist_id": "X", "artist_name": "A"}')
    good = tmp_path / "good"
    good.mkdir()
    (good / "a.json").write_text('{"userId": "1", "artist": "A", "page": "NextSong", "ts": 7, "sessionId": 1}')
    out = tmp_path / "out"
    store = run_pipeline(spark, str(good), str(songs), str(out))
    before, folders = counts(store), sorted(p.name for p in out.glob("*/*"))
    assert before["songplays"] == 1
    for mode in ("overwrite", APPEND):
        with pytest.raises(Exception, match="songplays.user_id must not be NULL"):
            run_pipeline(spark, str(logs), str(songs), str(out), mode)
        assert counts(store) == counts(TableStore(spark, str(out))) == before
        assert sorted(p.name for p in out.glob("*/*")) == folders


def test_unknown_mode(spark, tmp_path):
    with pytest.raises(ValueError):
        run_pipeline(spark, "x", "y", str(tmp_path), mode="merge")


def test_inserts_by_position_and_by_name(spark):
    table = TABLES["users"]
    values = spark.createDataFrame([(1, "a", "b", "F", "free")], "p int, q string, r string, s string, t string")
    assert by_position(values, table).columns == table.names
    with pytest.raises(ValueError):
        by_position(values.drop("t"), table)
    mixed = by_position(values, table).select("level", "gender", "user_id", "last_name", "first_name")
    assert by_name(mixed, table).first() == (1, "a", "b", "F", "free")


def test_rebuild_empties_only_the_named_tables(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    store.create_missing()
    row = spark.createDataFrame([(1, "a", "b", "F", "free")], TABLES["users"].schema)
    store.append("users", row)
    store.create_missing()
    store.rebuild(["songs"])
    assert store.read("users").count() == 1
    store.rebuild()
    assert store.read("users").count() == 0
    assert all(store.read(n).schema == TABLES[n].schema for n in TABLES)


def test_other_pages_never_change_the_fact(spark):
    events, songs_raw = (f(spark, SF_DIR) for f in (crosswalk.staging_events, crosswalk.staging_songs))
    from encore.operators.dimensions import build_artists, build_songs

    dims = build_artists(songs_raw), build_songs(songs_raw)
    only = build_songplays(events.where("page = 'NextSong'"), *dims)
    assert rows(build_songplays(events, *dims)) == rows(only)
