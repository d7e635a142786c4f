"""The seven tables: columns, types, widths, keys and physical layout.

Schemas are declared, never inferred. Column names are lower case throughout.
Spark file tables do not enforce keys, so the constraints recorded here feed
the checks in ``encore.operators.quality``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

INT = T.IntegerType()
LONG = T.LongType()
TEXT = T.StringType()
WHEN = T.TimestampNTZType()
MEASURE = T.DecimalType(10, 5)
WHOLE = T.DecimalType(18, 0)


@dataclass(frozen=True)
class Column:
    name: str
    type: T.DataType
    width: int | None = None  # most bytes a string may take
    required: bool = False


@dataclass(frozen=True)
class Reference:
    column: str
    table: str
    target: str


@dataclass(frozen=True)
class Table:
    name: str
    columns: tuple[Column, ...]
    key: str | None = None
    references: tuple[Reference, ...] = ()
    dist: str | None = None
    sort: str | None = None

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c.name, c.type) for c in self.columns])

    @property
    def required(self) -> list[str]:
        return [c.name for c in self.columns if c.required]

    @property
    def widths(self) -> dict[str, int]:
        return {c.name: c.width for c in self.columns if c.width is not None}


# Names, types, byte widths and keys of the stored tables.
STAGING_EVENTS = Table(
    "staging_events",
    (
        Column("artist", TEXT, 128),
        Column("auth", TEXT, 16),
        Column("firstname", TEXT, 128),
        Column("gender", TEXT, 1),
        Column("iteminsession", INT),
        Column("lastname", TEXT, 128),
        Column("length", MEASURE),
        Column("level", TEXT, 4),
        Column("location", TEXT, 256),
        Column("method", TEXT, 5),
        Column("page", TEXT, 16),
        Column("registration", WHOLE),
        Column("sessionid", INT),
        Column("song", TEXT, 256),
        Column("status", INT),
        Column("ts", LONG),
        Column("useragent", TEXT, 256),
        Column("userid", INT),
    ),
)

STAGING_SONGS = Table(
    "staging_songs",
    (
        Column("num_songs", INT),
        Column("artist_id", TEXT, 18),
        Column("artist_latitude", MEASURE),
        Column("artist_longitude", MEASURE),
        Column("artist_location", TEXT, 256),
        Column("artist_name", TEXT, 256),
        Column("song_id", TEXT, 18),
        Column("title", TEXT, 256),
        Column("duration", MEASURE),
        Column("year", INT),
    ),
)

USERS = Table(
    "users",
    (
        Column("user_id", INT, required=True),
        Column("first_name", TEXT, 128),
        Column("last_name", TEXT, 128),
        Column("gender", TEXT, 1),
        Column("level", TEXT, 4),
    ),
    key="user_id",
)

ARTISTS = Table(
    "artists",
    (
        Column("artist_id", TEXT, 18, required=True),
        Column("name", TEXT, 256),
        Column("location", TEXT, 256),
        Column("latitude", MEASURE),
        Column("longitude", MEASURE),
    ),
    key="artist_id",
    dist="artist_id",
)

SONGS = Table(
    "songs",
    (
        Column("song_id", TEXT, 18, required=True),
        Column("title", TEXT, 256, required=True),
        Column("artist_id", TEXT, 18, required=True),
        Column("year", INT),
        Column("duration", MEASURE),
    ),
    key="song_id",
    references=(Reference("artist_id", "artists", "artist_id"),),
    dist="song_id",
)

TIME = Table(
    "time",
    (
        Column("start_time", WHEN, required=True),
        Column("hour", INT, required=True),
        Column("day", INT, required=True),
        Column("week", INT, required=True),
        Column("month", INT, required=True),
        Column("year", INT, required=True),
        Column("weekday", INT, required=True),
    ),
    key="start_time",
)

SONGPLAYS = Table(
    "songplays",
    (
        Column("songplay_id", LONG, required=True),
        Column("start_time", WHEN, required=True),
        Column("user_id", INT, required=True),
        Column("level", TEXT, 4),
        Column("song_id", TEXT, 18, required=True),
        Column("artist_id", TEXT, 18, required=True),
        Column("session_id", INT, required=True),
        Column("location", TEXT, 256),
        Column("user_agent", TEXT, 256),
    ),
    key="songplay_id",
    references=(
        Reference("user_id", "users", "user_id"),
        Reference("song_id", "songs", "song_id"),
        Reference("artist_id", "artists", "artist_id"),
        Reference("start_time", "time", "start_time"),
    ),
    dist="song_id",
    sort="start_time",
)

# Parents before children: the order to create and fill them in.
TABLES = {
    t.name: t
    for t in (STAGING_EVENTS, STAGING_SONGS, USERS, ARTISTS, SONGS, TIME, SONGPLAYS)
}

# Made from the fact and the calendar by inserts: rows of their join per song, artist and month.
PLAYS_BY_MONTH = Table(
    "plays_by_month",
    (
        Column("song_id", TEXT, 18),
        Column("artist_id", TEXT, 18),
        Column("month", INT),
        Column("year", INT),
        Column("plays", LONG),
    ),
)
