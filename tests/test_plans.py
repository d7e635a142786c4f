"""Plan shapes that decide the cost at scale."""

import re

import pytest

from encore.operators.dimensions import build_artists, build_songs, build_time, build_users
from encore.operators.facts import build_songplays, numbered_songplays
from encore.plans.registry import Star
from encore.plans.reports import plays_per_song_month, star_join, top_artists, with_song
from encore.schemas import TABLES
from encore.sinks.layout import bucket_of, bucket_skew, lay_out, read_layout, read_tables, write_layout
from pyspark.sql import functions as F
from encore.sinks.store import TableStore
from encore.sources import crosswalk

SF_DIR = "/root/testdata/sf0.001"


def plan(df, final=False):
    if final:
        df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(text):
    return len(re.findall(r"\bExchange hashpartitioning|\bExchange rangepartitioning", text))


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    star = Star(spark, SF_DIR)
    kept = TableStore(spark, str(tmp_path_factory.mktemp("store")))
    for name in ("staging_events", "staging_songs", "users", "artists", "songs", "time"):
        kept.overwrite(name, star.named()[name])
    return kept


@pytest.fixture
def no_broadcast(spark):
    names = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    for name in names:
        spark.conf.set(name, "-1")
    yield
    for name in names:
        spark.conf.unset(name)


def test_users_read_narrow_columns_and_reduce_first(store):
    text = plan(build_users(store.read("staging_events")))
    read = [sorted(r.split(",")) for r in re.findall(r"ReadSchema: struct<([^>]*)>", text)]
    assert sorted(read) == [
        ["firstname:string", "gender:string", "lastname:string", "userid:int"],
        ["level:string", "ts:bigint", "userid:int"],
    ]
    # Every exchange of event rows has a partial aggregate right below it.
    below = re.findall(r"Exchange hashpartitioning[^\n]*\n[^A-Za-z]*(\w+)", text)
    assert "FileScan" not in below and "Project" not in below
    assert "partial_max" in text


def test_dimension_scans_read_their_columns_only(store):
    text = plan(build_time(store.read("staging_events")))
    assert "ReadSchema: struct<ts:bigint>" in text
    text = plan(build_songs(store.read("staging_songs")))
    assert "artist_name" not in text


def test_fact_shuffles_events_once_and_no_fact_rows(store, no_broadcast):
    fact = build_songplays(*map(store.read, ("staging_events", "artists", "songs")))
    text = plan(fact)
    assert "PushedFilters: [IsNotNull(page), EqualTo(page,NextSong)" in text
    # artists and songs with each other, then events and catalogue by name
    assert exchanges(text) == 4 and text.count("SortMergeJoin") == 2


def test_small_catalogue_is_broadcast_by_size(store):
    fact = build_songplays(*map(store.read, ("staging_events", "artists", "songs")))
    assert "BroadcastHashJoin" in plan(fact)


def test_hot_artist_is_split(spark, store, no_broadcast):
    """AQE must be able to split the partition of an artist with most plays."""
    small = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
    }
    for key, value in small.items():
        spark.conf.set(key, value)
    try:
        events = store.read("staging_events")
        name = store.read("artists").first()["name"]
        often = F.col("iteminsession") % 3 > 0
        hot = events.withColumns(
            {"artist": F.when(often, name).otherwise(F.col("artist")), "page": F.lit("NextSong")}
        ).repartition(8)
        fact = build_songplays(hot, store.read("artists"), store.read("songs"))
        text = plan(fact, final=True)
        assert "skew=true" in text
    finally:
        for key in small:
            spark.conf.unset(key)


def test_top_k_sorts_no_whole_table(store):
    fact = build_songplays(*map(store.read, ("staging_events", "artists", "songs")))
    text = plan(top_artists(fact, store.read("artists"), store.read("time"), 2024))
    assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text


def test_reports_count_before_dimension_joins(store, no_broadcast):
    star = [store.read(n) for n in ("staging_events", "artists", "songs")]
    fact = build_songplays(*star)
    text = plan(
        plays_per_song_month(fact, store.read("songs"), store.read("artists"), store.read("time"), 2024)
    )
    # From the top: final sum, joins with artists and songs, then the count of fact rows.
    assert text.index("partial_sum") < text.index("SortMergeJoin") < text.index("partial_count")


def test_year_prunes_the_stored_fact(spark, store, tmp_path):
    out = TableStore(spark, str(tmp_path))
    out.create_missing()
    text = plan(top_artists(out.read("songplays"), store.read("artists"), store.read("time"), 2024))
    assert "GreaterThanOrEqual(start_time,2024-01-01" in text
    assert re.search(r"start_time#\d+ < 2025-01-01", text)


def test_equal_buckets_join_without_exchange(spark, store, no_broadcast, tmp_path):
    fact = build_songplays(*map(store.read, ("staging_events", "artists", "songs")))
    write_layout(fact, "plan_plays", f"{tmp_path}/plays", "song_id", 4, "start_time")
    write_layout(store.read("songs"), "plan_songs", f"{tmp_path}/songs", "song_id", 4)
    joined = with_song(read_layout(spark, "plan_plays"), read_layout(spark, "plan_songs"))
    assert exchanges(plan(joined)) == 0
    assert joined.count() == fact.count() == 340
    assert {f.name for f in spark.table("plan_plays").schema} == set(fact.columns)
    assert TABLES["songplays"].dist == "song_id"


def _buckets(spark, name):
    described = spark.sql(f"DESCRIBE EXTENDED {name}").where("col_name = 'Num Buckets'")
    return [r["data_type"] for r in described.collect()]


def test_declared_layouts_do_not_depend_on_the_rows(spark, store, tmp_path):
    """A hot key, ten rows over many buckets, no rows at all: always bucketed as declared."""
    kept = TableStore(spark, str(tmp_path))
    kept.create_missing()
    kept.overwrite("songs", store.read("songs").limit(10))
    kept.overwrite("artists", store.read("artists").selectExpr("'X' as artist_id", "* except (artist_id)"))
    assert bucket_skew(kept.read("artists"), "artist_id", 64) == 64.0
    assert bucket_skew(kept.read("songplays"), "song_id", 64) == 0
    for name in lay_out(kept, 64, "declared"):
        assert _buckets(spark, name) == ["64"], name
    assert read_layout(spark, "declared.artists").count() == store.read("artists").count()


def test_layouts_belong_to_one_store(spark, store, tmp_path):
    small, large = TableStore(spark, f"{tmp_path}/small"), TableStore(spark, f"{tmp_path}/large")
    for kept, n in ((small, 5), (large, 50)):
        kept.create_missing()
        kept.overwrite("songs", store.read("songs").limit(n))
    lay_out(small, 2, "small_layouts")
    lay_out(large, 2, "large_layouts")
    assert [read_tables(k, d)["songs"].count() for k, d in ((small, "small_layouts"), (large, "large_layouts"))] == [5, 50]
    with pytest.raises(ValueError, match="another store"):
        lay_out(large, 2, "small_layouts")
    lay_out(small, 2, "small_layouts")  # the same store may be laid out again


def test_reports_on_layouts_join_songs_without_exchange(spark, store, no_broadcast, tmp_path):
    kept = TableStore(spark, str(tmp_path))
    kept.create_missing()
    kept.overwrite("songs", store.read("songs"))
    fact = build_songplays(*map(store.read, ("staging_events", "artists", "songs")))
    kept.append("songplays", fact.withColumn("songplay_id", F.monotonically_increasing_id()))
    lay_out(kept, 4, "report_layouts")
    tables = read_tables(kept, "report_layouts")
    assert exchanges(plan(with_song(tables["songplays"], tables["songs"]))) == 0
    counted = plays_per_song_month(*(tables[n] for n in ("songplays", "songs", "artists", "time")))
    assert "Bucketed: true" in plan(counted)


def test_star_join_multiplies_the_fact_last(store, no_broadcast):
    tables = [store.read(n) for n in ("songs", "artists", "time")]
    fact = build_songplays(*map(store.read, ("staging_events", "artists", "songs")))
    text = plan(star_join(fact, *tables))
    top = text.index("SortMergeJoin [song_id")
    assert top == text.index("SortMergeJoin"), "the catalogue of songs and artists is joined last"


def test_ids_compute_the_fan_out_once(store, no_broadcast):
    numbered, _ = numbered_songplays(*map(store.read, ("staging_events", "artists", "songs")))
    text = plan(numbered)
    assert "rangepartitioning" not in text  # of events only, before
    scans = [line for line in text.split("\n") if "FileScan parquet" in line]
    assert sum("session_id" in line for line in scans) == 1  # events that fan out, dealt by time before
    assert all("/encore-identity-" in line or "InMemoryFileIndex" in line for line in scans)


def test_songs_of_a_hot_artist_are_numbered_by_ranges(store):
    """No window holds a name: a third of all songs under one name are as many tasks as others."""
    star = [store.read(n) for n in ("staging_events", "artists", "songs")]
    numbered, _ = numbered_songplays(*star)
    text = numbered._jdf.queryExecution().optimizedPlan().toString()
    windows = re.findall(r"Window \[.*\], \[([^\]]*)\], \[[^\]]*\]$", text, re.M)
    assert windows and not any("_name" in w for w in windows)


def test_bucket_is_the_one_spark_writes(spark, tmp_path):
    ids = spark.range(40).select(F.col("id").cast("string").alias("k"))
    write_layout(ids, "plan_ids", str(tmp_path / "ids"), "k", 4)
    written = spark.table("plan_ids").select(
        F.regexp_extract(F.input_file_name(), r"_(\d{5})\.c", 1).cast("int").alias("file"),
        bucket_of("k", 4).alias("bucket"),
    )
    assert written.where("file != bucket").count() == 0 and written.count() == 40


def test_artists_scan_staging_once(store):
    assert plan(build_artists(store.read("staging_songs"))).count("FileScan") == 1


def test_a_counted_catalogue_is_broadcast_and_a_larger_one_is_not(spark):
    side = spark.range(10).withColumnRenamed("id", "k")
    plan = lambda df: df._jdf.queryExecution().analyzed().toString()
    for rows, hinted in ((10, True), (9, False)):
        chosen = crosswalk.counted_broadcast(side, rows)
        assert ("ResolvedHint" in plan(chosen)) is hinted and chosen.count() == 10
