"""Every operator and job as a query on the test tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from encore.functions.calendar import calendar_fields, epoch_ms_to_ts
from encore.operators import dimensions as dims
from encore.operators import facts, quality
from encore.plans import reports
from encore.plans.pipeline import run_pipeline
from encore.schemas import STAGING_EVENTS, STAGING_SONGS, TABLES
from encore.scratch import new_path, stage
from encore.sinks.layout import read_layout, write_layout
from encore.sinks.store import TableStore, by_position
from encore.sources import crosswalk, loaders
from encore.sources.objects import objects_of

YEAR = 2024  # the year of all test events


class Star:
    """Staging rows and the star schema built from them, all lazy."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    @cached_property
    def events(self) -> DataFrame:
        return crosswalk.staging_events(self.spark, self.sf_dir)

    @cached_property
    def songs_raw(self) -> DataFrame:
        return crosswalk.staging_songs(self.spark, self.sf_dir)

    @cached_property
    def users(self) -> DataFrame:
        return dims.build_users(self.events)

    @cached_property
    def artists(self) -> DataFrame:
        return dims.build_artists(self.songs_raw)

    @cached_property
    def songs(self) -> DataFrame:
        return dims.build_songs(self.songs_raw)

    @cached_property
    def time(self) -> DataFrame:
        return dims.build_time(self.events)

    @cached_property
    def songplays(self) -> DataFrame:
        return facts.build_songplays(self.events, self.artists, self.songs)

    def raw(self, name: str) -> DataFrame:
        return crosswalk.table(self.spark, self.sf_dir, name)

    def named(self) -> dict[str, DataFrame]:
        return {
            "staging_events": self.events,
            "staging_songs": self.songs_raw,
            "users": self.users,
            "artists": self.artists,
            "songs": self.songs,
            "time": self.time,
            "songplays": self.songplays,
        }


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _labelled(df: DataFrame, **labels: str) -> DataFrame:
    return df.select(*[F.lit(v).alias(k) for k, v in labels.items()], "*")


# Sources and sinks


def load_events(star: Star) -> DataFrame:
    path = new_path(star.spark, "logs")
    crosswalk.write_logs(star.spark, star.sf_dir, path)
    return loaders.load_events(star.spark, path)


def load_songs(star: Star) -> DataFrame:
    path = new_path(star.spark, "catalogue")
    crosswalk.write_catalogue(star.spark, star.sf_dir, path)
    return loaders.load_songs(star.spark, path, layout=loaders.LINES)


def coerce_types(star: Star) -> DataFrame:
    texts = star.events.select(*[F.col(c).cast("string").alias(c) for c in star.events.columns])
    written = texts.withColumns(
        {
            "userid": F.coalesce("userid", F.lit("")),
            "registration": F.concat("registration", F.lit(".0")),
            # A sixth decimal to be cut off.
            "length": F.concat("length", F.lit("9")),
        }
    )
    return loaders.coerce(written, STAGING_EVENTS)


def bad_records(star: Star) -> DataFrame:
    kind = F.col("event_type")
    line = (
        F.when(kind == "error", F.expr("substr(props, 1, length(props) - 1)"))
        .when(kind == "signup", F.concat(F.lit('{"userId": "u'), "event_id", F.lit('"}')))
        .when(kind == "purchase", F.concat(F.lit('{"GENDER": "'), kind, F.lit('"}{"userId": "7"} {"ts": "}{"}')))
        .when(kind == "click", F.concat("props", F.lit(" and more")))
        .otherwise(F.concat("props", F.lit(" "), "props"))
    )
    lines = star.raw("events").select(line.alias("value"))
    return loaders.bad_records(objects_of(lines), STAGING_EVENTS)


def append_sink(star: Star) -> DataFrame:
    store = TableStore(star.spark, new_path(star.spark, "append"))
    for _ in range(2):
        store.append("users", by_position(star.users, TABLES["users"]))
    return store.read("users")


def rebuild_tables(star: Star) -> DataFrame:
    store = TableStore(star.spark, new_path(star.spark, "rebuild"))
    store.create_missing()
    filled = ["users", "artists", "songs", "time"]
    for name in filled:
        store.append(name, star.named()[name])

    def counts(column: str) -> DataFrame:
        return _union(
            [_labelled(store.read(n).agg(F.count("*").alias(column)), table_name=n) for n in filled]
        )

    # The counts are stored first, because the rebuild replaces the rows.
    before, _ = stage(counts("rows_before"), "counts")
    store.rebuild()
    return before.join(counts("rows_after"), "table_name")


def layout_roundtrip(star: Star) -> DataFrame:
    root = new_path(star.spark, "layout")
    tag = root.rsplit("-", 1)[1]
    plays, songs = f"songplays_{tag}", f"songs_{tag}"
    buckets = int(star.spark.conf.get("spark.sql.shuffle.partitions"))
    write_layout(star.songplays, plays, f"{root}/songplays", "song_id", buckets, "start_time")
    write_layout(star.songs, songs, f"{root}/songs", "song_id", buckets)
    joined = reports.with_song(read_layout(star.spark, plays), read_layout(star.spark, songs))
    return reports.count_plays(joined, ["sp.song_id", "sn.title"], counted="sp.song_id")


def songplays_with_id(star: Star) -> DataFrame:
    return _numbered(star)


def _numbered(star: Star) -> DataFrame:
    numbered, _ = facts.numbered_songplays(star.events, star.artists, star.songs)
    return numbered.drop(facts.RANGE)


def pipeline_counts(star: Star) -> DataFrame:
    root = new_path(star.spark, "pipeline")
    crosswalk.write_logs(star.spark, star.sf_dir, f"{root}/logs")
    crosswalk.write_catalogue(star.spark, star.sf_dir, f"{root}/catalogue")
    store = run_pipeline(
        star.spark, f"{root}/logs", f"{root}/catalogue", f"{root}/tables", songs_format=loaders.LINES
    )
    return _union(
        [
            _labelled(store.read(name).agg(F.count("*").alias("row_count")), table_name=name)
            for name in TABLES
        ]
    )


# Checks


def not_null_violations(star: Star) -> DataFrame:
    # Staging declares nothing as required; these columns feed required ones.
    required = {"staging_events": ["ts", "userid", "sessionid"]}
    required.update({n: t.required for n, t in TABLES.items() if t.required})
    tables = {**star.named(), "songplays": _numbered(star)}
    return _union(
        [
            _labelled(quality.not_null_violations(tables[n], columns), table_name=n)
            for n, columns in required.items()
        ]
    )


def width_violations(star: Star) -> DataFrame:
    checks = [
        _labelled(quality.width_violations(df, TABLES[n].widths), table_name=n)
        for n, df in star.named().items()
        if TABLES[n].widths
    ]
    # Texts longer than a title may be, many of them not ASCII.
    texts = quality.width_violations(star.raw("documents"), {"text": 256})
    return _union([*checks, _labelled(texts, table_name="documents")])


def key_violations(star: Star) -> DataFrame:
    tables = {**star.named(), "songplays": _numbered(star)}
    return _union(
        [
            _labelled(
                quality.key_violations(tables[n], [TABLES[n].key]).select(
                    F.col(TABLES[n].key).cast("string").alias("key_value"), "copies"
                ),
                table_name=n,
            )
            for n in ("users", "artists", "songs", "time", "songplays")
        ]
    )


def fk_violations(star: Star) -> DataFrame:
    # Stored first, as the checks of real tables find them: the fact has four
    # references, and each check then reads one column of it.
    names = ["users", "artists", "songs", "time", "songplays"]
    tables = {n: stage(star.named()[n], n)[0] for n in names}
    declared = [quality.reference_violations(TABLES[n], tables) for n in ("songs", "songplays")]
    # Not declared, and not always true: the artist of an event is catalogued.
    by_name = quality.fk_violations(star.events, tables["artists"], {"artist": "name"})
    loose = _labelled(
        by_name, table_name="staging_events", column_name="artist", parent_name="artists"
    )
    return _union([*declared, loose])


# Projections, joins and aggregates


def epoch_to_timestamp(star: Star) -> DataFrame:
    at = F.col("ts")
    millis = F.floor(F.date_part(F.lit("SECOND"), at) * 1000)
    epoch = (
        F.unix_date(at.cast("date")).cast("long") * 86_400_000
        + F.hour(at).cast("long") * 3_600_000
        + F.minute(at).cast("long") * 60_000
        + millis
    )
    timed = star.raw("events").select("event_id", epoch.cast("long").alias("epoch_ms"))
    return timed.withColumn("start_time", epoch_ms_to_ts(F.col("epoch_ms")))


def _order_calendar(star: Star) -> DataFrame:
    dates = star.raw("orders").select("o_orderdate").distinct()
    return dates.select(F.col("o_orderdate").alias("start_time"), *calendar_fields(F.col("o_orderdate")))


def plays_in_year(star: Star) -> DataFrame:
    timed = reports.with_time(star.songplays.alias("sp"), star.time)
    return reports.in_year(timed, YEAR, "tm.year").select("sp.*", "tm.month", "tm.year")


def event_artist_join(star: Star) -> DataFrame:
    return facts.event_artist_join(facts.nextsong_events(star.events), star.artists).select(
        "ev.ts", "ev.userid", "ev.sessionid", "ev.artist", "ar.artist_id", "ar.name",
        F.col("ar.location").alias("artist_location"),
    )


def artist_songs(star: Star) -> DataFrame:
    return facts.artist_songs(star.artists, star.songs).select(
        "ar.artist_id", "ar.name", "ar.location", "so.song_id", "so.title"
    )


def star_join(star: Star) -> DataFrame:
    return reports.star_join(star.songplays, star.songs, star.artists, star.time).select(
        "sp.start_time", "sp.user_id", "sp.song_id", "sn.title", "sp.artist_id", "art.name",
        F.col("art.location").alias("artist_location"), "tm.month", "tm.year", "tm.weekday",
    )


def artist_plays(star: Star) -> DataFrame:
    return reports.artist_plays(star.artists, star.songplays).select(
        "art.artist_id", "art.name", F.col("art.location").alias("artist_location"),
        "sp.start_time", "sp.user_id", "sp.song_id",
    )


def plays_per_song_month(star: Star) -> DataFrame:
    return reports.plays_per_song_month(star.songplays, star.songs, star.artists, star.time)


def plays_per_artist(star: Star) -> DataFrame:
    return reports.plays_per_artist(star.songplays, star.artists, star.time)


def top_songs(star: Star) -> DataFrame:
    return reports.top_songs(star.songplays, star.songs, star.artists, star.time, YEAR)


def top_artists(star: Star) -> DataFrame:
    return reports.top_artists(star.songplays, star.artists, star.time, YEAR)


JOBS: dict[str, Callable[[Star], DataFrame]] = {
    "staging_events": lambda s: s.events,
    "staging_songs": lambda s: s.songs_raw,
    "load_events": load_events,
    "load_songs": load_songs,
    "coerce_types": coerce_types,
    "bad_records": bad_records,
    "append_sink": append_sink,
    "rebuild_tables": rebuild_tables,
    "not_null_violations": not_null_violations,
    "key_violations": key_violations,
    "fk_violations": fk_violations,
    "width_violations": width_violations,
    "layout_roundtrip": layout_roundtrip,
    "nextsong_events": lambda s: facts.nextsong_events(s.events),
    "plays_in_year": plays_in_year,
    "event_artist_join": event_artist_join,
    "artist_songs": artist_songs,
    "star_join": star_join,
    "artist_plays": artist_plays,
    "last_event_per_user": lambda s: dims.last_event_per_user(s.events),
    "latest_level_per_user": lambda s: dims.latest_level_per_user(s.events),
    "plays_per_song_month": plays_per_song_month,
    "plays_per_artist": plays_per_artist,
    "epoch_to_timestamp": epoch_to_timestamp,
    "calendar_fields": _order_calendar,
    "calendar_of_year": lambda s: reports.in_year(_order_calendar(s), 1998),
    "users": lambda s: s.users,
    "artists": lambda s: s.artists,
    "songs": lambda s: s.songs,
    "time_dim": lambda s: s.time,
    "songplays": lambda s: s.songplays,
    "songplays_with_id": songplays_with_id,
    "top_songs": top_songs,
    "top_artists": top_artists,
    "pipeline_counts": pipeline_counts,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(job: Callable[[Star], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, sf_dir: job(Star(spark, sf_dir))

    return {name: bind(job) for name, job in JOBS.items()}
