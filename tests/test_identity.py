"""Dense ids: no gaps, the same on a rerun, known before the rows fan out."""

import pytest
from conftest import rows

from encore.operators.facts import numbered_songplays
from encore.operators.identity import with_offsets
from encore.scratch import discard, shared_root
from pyspark.sql import Window
from pyspark.sql import functions as F


def sample(spark, n=1000):
    return spark.range(n).select(
        (F.col("id") * 7919 % 1009).alias("a"), (F.col("id") % 13).cast("string").alias("b"),
        (F.col("id") % 4 + 1).alias("width"),
    )


def test_offsets_equal_a_global_running_sum(spark):
    df = sample(spark)
    placed, _ = with_offsets(df, ["a", "b"], "width", "first", "part")
    before = Window.orderBy("a", "b").rowsBetween(Window.unboundedPreceding, -1)
    plain = df.withColumn("first", F.coalesce(F.sum("width").over(before), F.lit(0)))
    assert rows(placed, "a", "b", "first") == rows(plain, "a", "b", "first")


def test_same_on_rerun_whatever_the_partitions(spark):
    one, _ = with_offsets(sample(spark), ["a", "b"], "width", "first", "part")
    other, _ = with_offsets(sample(spark).repartition(7), ["a", "b"], "width", "first", "part")
    assert rows(one, "a", "b", "first") == rows(other, "a", "b", "first")


def test_empty_input(spark):
    placed, _ = with_offsets(sample(spark, 0), ["a", "b"], "width", "first", "part")
    assert placed.count() == 0


def test_staged_rows_live_in_the_shared_folder(spark):
    _, path = with_offsets(sample(spark, 10), ["a", "b"], "width", "first", "part")
    assert path.startswith(spark.conf.get("spark.checkpoint.dir"))
    assert shared_root(spark) == spark.conf.get("spark.checkpoint.dir")
    discard(spark, path)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)


def test_ids_of_copies_variants_and_ties(spark, make_events, make_songs):
    events = make_events(*[dict(ts=t, artist=a) for t in (30, 10, 10, 20) for a in ("A", "B", "none")])
    artists = spark.createDataFrame([("A1", "A", "x"), ("A1", "A", "y"), ("B1", "B", "x")], "artist_id string, name string, location string")
    songs = spark.createDataFrame([("S1", "A1", "t"), ("S2", "A1", "u"), ("S3", "B1", "v")], "song_id string, artist_id string, title string")
    found, _ = numbered_songplays(events, artists, songs, start=100)
    got = [(r.songplay_id, r.artist_id, r.song_id) for r in found.orderBy("songplay_id").collect()]
    assert [g[0] for g in got] == list(range(100, 120))
    first = [g[1:] for g in got[:10]]  # two copies of each of both events at the first time
    assert first == [("A1", "S1")] * 4 + [("A1", "S2")] * 4 + [("B1", "S3")] * 2
    assert [g[1:] for g in got[10:15]] == [("A1", "S1")] * 2 + [("A1", "S2")] * 2 + [("B1", "S3")]


def test_many_copies_of_one_event(spark, make_events, make_songs, monkeypatch):
    monkeypatch.setattr("encore.operators.facts.COPIES_AT_ONCE", 3)
    events = make_events(*[dict(ts=5)] * 10)
    artists = spark.createDataFrame([("A1", "A", "x")], "artist_id string, name string, location string")
    songs = spark.createDataFrame([("S1", "A1", "t"), ("S2", "A1", "u")], "song_id string, artist_id string, title string")
    found, _ = numbered_songplays(events, artists, songs)
    assert [r.songplay_id for r in found.orderBy("songplay_id").collect()] == list(range(20))


def test_tasks_are_dealt_by_the_rows_that_events_become(spark, make_events, monkeypatch):
    """Few bytes of events, one artist and many rows: no task makes more than a small share of them."""
    monkeypatch.setattr("encore.operators.facts.ROWS_AT_ONCE", 500, raising=False)
    monkeypatch.setattr("encore.operators.facts.COPIES_AT_ONCE", 50)
    events = make_events(dict(ts=5)).selectExpr("* except (ts)", "explode(sequence(3600000L, 1080000000L, 3600000L)) as ts")
    events = events.unionByName(make_events(*[dict(ts=7, artist="B")] * 200))
    artists = spark.createDataFrame([("A1", "A", "x"), ("B1", "B", "x")], "artist_id string, name string, location string")
    songs = spark.range(20).selectExpr("concat('S', id) as song_id", "if(id < 15, 'A1', 'B1') as artist_id", "'t' as title")
    found, _ = numbered_songplays(events, artists, songs)
    made = rows(found.select("songplay_id", F.spark_partition_id().alias("task")), "songplay_id", "task")
    assert [i for i, _ in made] == list(range(300 * 15 + 200 * 5))
    tasks = [t for _, t in made]
    assert max(map(tasks.count, set(tasks))) <= 2500
