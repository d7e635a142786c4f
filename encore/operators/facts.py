"""The songplays fact: events matched to every song of the artist played."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.functions.calendar import epoch_ms_to_ts
from encore.functions.text import name_key
from encore.operators.identity import with_offsets

FACT_COLUMNS = [
    "start_time",
    "user_id",
    "level",
    "song_id",
    "artist_id",
    "session_id",
    "location",
    "user_agent",
]

# Events first, so the order of ids follows time.
EVENT_ORDER = ["start_time", "user_id", "session_id", "level", "location", "user_agent"]
SONG_ORDER = ["artist_id", "song_id"]
RANGE = "_range"
COPIES_AT_ONCE = 10_000
ROWS_AT_ONCE = 250_000  # fact rows that a task makes, about


def nextsong_events(events: DataFrame) -> DataFrame:
    """Only the events that stream a song."""
    return events.where(F.col("page") == "NextSong")


def event_artist_join(events: DataFrame, artists: DataFrame) -> DataFrame:
    """Events with each artist row of that name; unmatched names drop out."""
    return events.alias("ev").join(
        artists.alias("ar"), name_key(F.col("ev.artist")) == name_key(F.col("ar.name"))
    )


def artist_songs(artists: DataFrame, songs: DataFrame) -> DataFrame:
    """Every artist row with every song of that artist."""
    return artists.alias("ar").join(
        songs.alias("so"), F.col("ar.artist_id") == F.col("so.artist_id")
    )


def _play_columns(events: DataFrame) -> DataFrame:
    return nextsong_events(events).select(
        name_key(F.col("artist")).alias("_name"),
        epoch_ms_to_ts(F.col("ts")).alias("start_time"),
        F.col("userid").alias("user_id"),
        "level",
        F.col("sessionid").alias("session_id"),
        "location",
        F.col("useragent").alias("user_agent"),
    )


def build_songplays(events: DataFrame, artists: DataFrame, songs: DataFrame) -> DataFrame:
    """Fact rows without an id.

    The dimensions are joined with each other first. Events then pass one join,
    on the name, and the rows it fans out to are never shuffled. AQE broadcasts
    the catalogue if it is small and splits the partitions of a hot artist if
    it is not.
    """
    return _play_columns(events).join(_catalogue(artists, songs), "_name").select(*FACT_COLUMNS)


def _catalogue(artists: DataFrame, songs: DataFrame) -> DataFrame:
    return artist_songs(artists, songs).select(
        name_key(F.col("ar.name")).alias("_name"), F.col("ar.artist_id"), F.col("so.song_id")
    )


def numbered_songplays(
    events: DataFrame, artists: DataFrame, songs: DataFrame, start: int = 0
) -> tuple[DataFrame, list[str]]:
    """Fact rows with ``songplay_id``, numbered from ``start`` by EVENT_ORDER, name and SONG_ORDER.

    The order goes by events first, so ids are known before the fan-out: an event's rows
    follow each other, as many as its name has catalogue rows, and alike events take turns.
    Only the distinct events are put in order; the fan-out is computed once and not
    shuffled for its ids. RANGE numbers the ranges of events by time.

    Names that no artist has drop out before. One name with several artists shares an
    event's ids among the catalogue rows of all of them. Events are few bytes and may become
    many rows, so tasks are dealt by those rows, in parts of a name if it has many. Returns
    the rows and the staged paths that may be discarded after use.
    """
    # An artist's songs are numbered by running sums over ranges, never in one task per name.
    alike = _catalogue(artists, songs).groupBy("_name", *SONG_ORDER).agg(F.count("*").alias("_rows"))
    summed, songs_path = with_offsets(alike, ["_name", *SONG_ORDER], "_rows", "_at", "_songs")
    fan = summed.groupBy("_name").agg(F.sum("_rows").alias("_fan"), F.min("_at").alias("_first"))
    placed = summed.join(fan.select("_name", "_first"), "_name").withColumn("_start", F.col("_at") - F.col("_first"))
    each_row = F.explode(F.sequence("_start", F.col("_start") + F.col("_rows") - 1)).alias("_place")
    catalogue = placed.select("_name", *SONG_ORDER, each_row)
    fan = fan.select("_name", "_fan")
    alike = _play_columns(events).groupBy(*EVENT_ORDER, "_name").agg(F.count("*").alias("_copies"))
    wide = alike.join(fan, "_name").withColumn("_width", F.col("_copies") * F.col("_fan"))
    spread, path = with_offsets(wide, [*EVENT_ORDER, "_name"], "_width", "_offset", RANGE)
    # in two steps, as one event may have any number of copies
    from_copy = F.sequence(F.lit(0).cast("long"), F.col("_copies") - 1, F.lit(COPIES_AT_ONCE).cast("long"))
    to_copy = F.least(F.col("_copies"), F.col("_from") + COPIES_AT_ONCE) - 1
    each = _dealt_by_rows(spread.withColumn("_from", F.explode(from_copy)), catalogue, path)
    each = each.withColumn("_copy", F.explode(F.sequence("_from", to_copy)))
    number = F.col("_offset") + F.col("_place") * F.col("_copies") + F.col("_copy") + F.lit(start)
    numbered = each.withColumn("songplay_id", number.cast("long"))
    return numbered.select("songplay_id", *FACT_COLUMNS, RANGE), [path, songs_path]


def _dealt_by_rows(events: DataFrame, catalogue: DataFrame, path: str) -> DataFrame:
    """``events`` joined with ``catalogue`` by name, in as many tasks as the rows they become ask for.

    A name of many rows is dealt in parts: its events are shared among them, and each has its
    catalogue rows. ``path`` has the stored events with the ``_width`` of each.
    """
    stored = events.sparkSession.read.parquet(path)
    pieces = F.sum(F.ceil(F.col("_copies") / COPIES_AT_ONCE))
    rows = stored.groupBy("_name").agg(F.sum("_width").alias("_all"), pieces.alias("_pieces"))
    total = rows.agg(F.sum("_all")).first()[0] or 0
    parts = F.least(F.floor(F.col("_all") / ROWS_AT_ONCE) + 1, "_pieces").alias("_parts")
    # at most one name per ROWS_AT_ONCE rows
    large = F.broadcast(rows.where(F.col("_all") >= ROWS_AT_ONCE).select("_name", parts))
    one = F.lit(1).cast("long")
    part = F.pmod(F.xxhash64("_offset", "_from"), F.coalesce("_parts", one)).alias("_part")
    every = F.explode(F.sequence(one - 1, F.coalesce("_parts", one) - 1)).alias("_part")
    tasks = int(total // ROWS_AT_ONCE) + 1
    dealt = [
        side.join(large, "_name", "left").select(*side.columns, which).repartition(tasks, "_name", "_part")
        for side, which in ((events, part), (catalogue, every))
    ]
    return dealt[0].join(dealt[1], ["_name", "_part"])
