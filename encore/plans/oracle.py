"""The registered queries as plain SQL on the same parquet tables.

Written against the definition of each table and not against the Spark jobs:
the fact is the plain join, counts are taken on the unfolded star, and latest
levels come from a lookup of each user's newest time.
"""

from __future__ import annotations

STAGING = """
staging_events AS (
    SELECT 'Supplier#' || lpad(CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) + 5 AS VARCHAR), 9, '0') AS artist,
           CASE WHEN event_type = 'error' THEN 'Logged Out' ELSE 'Logged In' END AS auth,
           'Customer' AS firstname,
           CASE WHEN user_id % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
           CAST(event_id % 50 AS INTEGER) AS iteminsession,
           c_name AS lastname,
           CAST("value" AS DECIMAL(10,5)) AS "length",
           CASE WHEN event_id % 3 = 0 THEN 'paid' ELSE 'free' END AS "level",
           n_name AS "location",
           CASE WHEN event_type = 'view' THEN 'PUT' ELSE 'GET' END AS "method",
           CASE event_type WHEN 'view' THEN 'NextSong' WHEN 'click' THEN 'Home'
                WHEN 'signup' THEN 'Upgrade' WHEN 'purchase' THEN 'Settings'
                WHEN 'error' THEN 'Error' END AS page,
           CAST(1500000000000 + user_id AS DECIMAL(18,0)) AS registration,
           CAST(user_id * 31 + extract(day FROM ts) AS INTEGER) AS sessionid,
           'Song ' || CAST(event_id % 64 AS VARCHAR) AS song,
           CASE WHEN event_type = 'error' THEN 404 ELSE 200 END AS status,
           epoch_us(ts) // 3600000000 * 3600000 AS ts,
           'agent/' || CAST(user_id % 7 AS VARCHAR) AS useragent,
           CASE WHEN event_type = 'error' THEN NULL ELSE CAST(user_id AS INTEGER) END AS userid
    FROM events
    JOIN customer ON c_custkey = user_id
    JOIN nation ON n_nationkey = c_nationkey
),
staging_songs AS (
    SELECT 1 AS num_songs,
           'AR' || lpad(CAST(s_suppkey AS VARCHAR), 16, '0') AS artist_id,
           CASE WHEN s_acctbal >= 0 THEN CAST(s_acctbal / 1000 AS DECIMAL(10,5)) END AS artist_latitude,
           CASE WHEN s_acctbal >= 0 THEN CAST(-s_acctbal / 100 AS DECIMAL(10,5)) END AS artist_longitude,
           CASE WHEN p_size <= 2 THEN '' ELSE n_name END AS artist_location,
           s_name AS artist_name,
           'SO' || lpad(CAST(p_partkey AS VARCHAR), 16, '0') AS song_id,
           p_name AS title,
           CAST(p_retailprice AS DECIMAL(10,5)) AS duration,
           CASE WHEN p_size <= 5 THEN 0 ELSE 1970 + p_size END AS "year"
    FROM lineitem
    JOIN part ON p_partkey = l_partkey
    JOIN supplier ON s_suppkey = p_partkey % (SELECT count(*) FROM supplier)
    JOIN nation ON n_nationkey = s_nationkey
)"""

STAR = f"""WITH {STAGING.strip()},
newest AS (
    SELECT userid, max(ts) AS last_ts FROM staging_events WHERE userid IS NOT NULL GROUP BY userid
),
latest AS (
    SELECT DISTINCT userid, "level", last_ts
    FROM staging_events NATURAL JOIN newest
    WHERE ts = last_ts
),
users AS (
    SELECT DISTINCT latest.userid AS user_id, firstname AS first_name, lastname AS last_name,
           gender, latest."level" AS "level"
    FROM staging_events JOIN latest ON latest.userid = staging_events.userid
),
artists AS (
    SELECT DISTINCT artist_id, artist_name AS "name", artist_location AS "location",
           artist_latitude AS latitude, artist_longitude AS longitude
    FROM staging_songs
),
songs AS (
    SELECT DISTINCT song_id, title, artist_id, "year", duration FROM staging_songs
),
moments AS (
    SELECT DISTINCT make_timestamp(ts * 1000) AS start_time FROM staging_events
),
calendar AS (
    SELECT start_time,
           CAST(extract(hour FROM start_time) AS INTEGER) AS "hour",
           CAST(extract(day FROM start_time) AS INTEGER) AS "day",
           CAST(extract(week FROM start_time) AS INTEGER) AS "week",
           CAST(extract(month FROM start_time) AS INTEGER) AS "month",
           CAST(extract(year FROM start_time) AS INTEGER) AS "year",
           CAST(extract(dow FROM start_time) AS INTEGER) AS weekday
    FROM moments
),
songplays AS (
    SELECT make_timestamp(e.ts * 1000) AS start_time, e.userid AS user_id, e."level",
           s.song_id, a.artist_id, e.sessionid AS session_id, e."location",
           e.useragent AS user_agent
    FROM staging_events e, artists a, songs s
    WHERE e.page = 'NextSong'
      AND rtrim(e.artist, ' ') = rtrim(a."name", ' ')
      AND s.artist_id = a.artist_id
),
star AS (
    SELECT p.start_time, p.user_id, p.song_id, s.title, p.artist_id, a."name",
           a."location" AS artist_location, c."month", c."year", c.weekday
    FROM songplays p
    JOIN songs s ON s.song_id = p.song_id
    JOIN artists a ON a.artist_id = s.artist_id
    JOIN calendar c ON c.start_time = p.start_time
),
numbered AS (
    SELECT row_number() OVER (
               ORDER BY start_time, user_id, session_id, "level", "location", user_agent, artist_id, song_id
           ) - 1 AS songplay_id, *
    FROM songplays
)
"""

NUMBERED = "SELECT * FROM numbered"

DATES = """
SELECT DISTINCT o_orderdate AS start_time,
       CAST(extract(hour FROM o_orderdate) AS INTEGER) AS "hour",
       CAST(extract(day FROM o_orderdate) AS INTEGER) AS "day",
       CAST(extract(week FROM o_orderdate) AS INTEGER) AS "week",
       CAST(extract(month FROM o_orderdate) AS INTEGER) AS "month",
       CAST(extract(year FROM o_orderdate) AS INTEGER) AS "year",
       CAST(extract(dow FROM o_orderdate) AS INTEGER) AS weekday
FROM orders
"""

# Required columns and byte widths per table, as declared.
REQUIRED = {
    "staging_events": ["ts", "userid", "sessionid"],
    "users": ["user_id"],
    "artists": ["artist_id"],
    "songs": ["song_id", "title", "artist_id"],
    "time": ["start_time", "hour", "day", "week", "month", "year", "weekday"],
    "songplays": ["songplay_id", "start_time", "user_id", "song_id", "artist_id", "session_id"],
}
WIDTHS = {
    "staging_events": {
        "artist": 128, "auth": 16, "firstname": 128, "gender": 1, "lastname": 128, "level": 4,
        "location": 256, "method": 5, "page": 16, "song": 256, "useragent": 256,
    },
    "staging_songs": {
        "artist_id": 18, "artist_location": 256, "artist_name": 256, "song_id": 18, "title": 256,
    },
    "users": {"first_name": 128, "last_name": 128, "gender": 1, "level": 4},
    "artists": {"artist_id": 18, "name": 256, "location": 256},
    "songs": {"song_id": 18, "title": 256, "artist_id": 18},
    "songplays": {"level": 4, "song_id": 18, "artist_id": 18, "location": 256, "user_agent": 256},
    "documents": {"text": 256},
}
# A relation named time would need quoting everywhere; ids are given out apart from the plain fact.
RELATIONS = {"time": "calendar"}
NUMBERED_RELATIONS = {**RELATIONS, "songplays": "numbered"}


def _each(template: str, cases: list[dict]) -> str:
    return "\nUNION ALL\n".join(template.format(**case) for case in cases)


def _not_null() -> str:
    template = (
        "SELECT '{t}' AS table_name, '{c}' AS column_name, "
        'count(*) - count("{c}") AS violations FROM {r}'
    )
    return _each(
        template,
        [{"t": t, "c": c, "r": NUMBERED_RELATIONS.get(t, t)} for t, cols in REQUIRED.items() for c in cols],
    )


def _widths() -> str:
    template = (
        "SELECT '{t}' AS table_name, '{c}' AS column_name, "
        'count(*) FILTER (WHERE strlen("{c}") > {w}) AS violations FROM {r}'
    )
    return _each(
        template,
        [
            {"t": t, "c": c, "w": w, "r": RELATIONS.get(t, t)}
            for t, widths in WIDTHS.items()
            for c, w in widths.items()
        ],
    )


def _keys() -> str:
    template = (
        "SELECT '{t}' AS table_name, CAST({k} AS VARCHAR) AS key_value, count(*) AS copies "
        "FROM {r} GROUP BY {k} HAVING count(*) > 1"
    )
    keys = {
        "users": "user_id", "artists": "artist_id", "songs": "song_id", "time": "start_time",
        "songplays": "songplay_id",
    }
    return _each(template, [{"t": t, "k": k, "r": NUMBERED_RELATIONS.get(t, t)} for t, k in keys.items()])


def _references() -> str:
    template = (
        "SELECT '{t}' AS table_name, '{c}' AS column_name, '{p}' AS parent_name, "
        "count(*) AS violations FROM {t} "
        'WHERE {c} IS NOT NULL AND {c} NOT IN (SELECT "{k}" FROM {r} WHERE "{k}" IS NOT NULL)'
    )
    references = [
        ("songs", "artist_id", "artists", "artist_id"),
        ("songplays", "user_id", "users", "user_id"),
        ("songplays", "song_id", "songs", "song_id"),
        ("songplays", "artist_id", "artists", "artist_id"),
        ("songplays", "start_time", "time", "start_time"),
        ("staging_events", "artist", "artists", "name"),
    ]
    return _each(
        template,
        [{"t": t, "c": c, "p": p, "k": k, "r": RELATIONS.get(p, p)} for t, c, p, k in references],
    )


def _counts(column: str, relations: dict[str, str]) -> str:
    template = "SELECT '{t}' AS table_name, count(*) AS {c} FROM {r}"
    return _each(template, [{"t": t, "c": column, "r": r} for t, r in relations.items()])


DIMENSIONS = {"users": "users", "artists": "artists", "songs": "songs", "time": "calendar"}
ALL_TABLES = {
    "staging_events": "staging_events",
    "staging_songs": "staging_songs",
    **DIMENSIONS,
    "songplays": "songplays",
}

BODIES = {
    "staging_events": "SELECT * FROM staging_events",
    "staging_songs": "SELECT * FROM staging_songs",
    "load_events": "SELECT * FROM staging_events",
    "load_songs": "SELECT * FROM staging_songs",
    "coerce_types": """
        SELECT * REPLACE (CAST(regexp_replace(CAST("length" AS VARCHAR) || '9', '(\\.[0-9]{5})[0-9]+$', '\\1')
                          AS DECIMAL(10,5)) AS "length") FROM staging_events
    """,
    "bad_records": """
        SELECT substr(props, 1, length(props) - 1) AS "value", 'not json' AS reason
        FROM events WHERE event_type = 'error'
        UNION ALL
        SELECT '{"userId": "u' || event_id || '"}', 'type of userid'
        FROM events WHERE event_type = 'signup'
        UNION ALL
        SELECT '{"GENDER": "' || event_type || '"}', 'width of gender'
        FROM events WHERE event_type = 'purchase'
        UNION ALL
        SELECT '{"ts": "}{"}', 'type of ts' FROM events WHERE event_type = 'purchase'
        UNION ALL
        SELECT 'and more', 'not json' FROM events WHERE event_type = 'click'
    """,
    "append_sink": "SELECT * FROM users UNION ALL SELECT * FROM users",
    "rebuild_tables": f"""
        SELECT *, CAST(0 AS BIGINT) AS rows_after FROM ({_counts("rows_before", DIMENSIONS)})
    """,
    "not_null_violations": _not_null(),
    "width_violations": _widths(),
    "key_violations": _keys(),
    "fk_violations": _references(),
    "layout_roundtrip": """
        SELECT p.song_id, s.title, count(*) AS plays
        FROM songplays p JOIN songs s ON s.song_id = p.song_id
        GROUP BY ALL
    """,
    "nextsong_events": "SELECT * FROM staging_events WHERE page = 'NextSong'",
    "plays_in_year": """
        SELECT songplays.*, c."month", c."year"
        FROM songplays JOIN calendar c ON c.start_time = songplays.start_time
        WHERE c."year" = 2024
    """,
    "event_artist_join": """
        SELECT e.ts, e.userid, e.sessionid, e.artist, a.artist_id, a."name",
               a."location" AS artist_location
        FROM staging_events e JOIN artists a ON rtrim(a."name", ' ') = rtrim(e.artist, ' ')
        WHERE e.page = 'NextSong'
    """,
    "artist_songs": """
        SELECT a.artist_id, a."name", a."location", s.song_id, s.title
        FROM artists a JOIN songs s ON s.artist_id = a.artist_id
    """,
    "star_join": "SELECT * FROM star",
    "artist_plays": """
        SELECT a.artist_id, a."name", a."location" AS artist_location,
               p.start_time, p.user_id, p.song_id
        FROM songplays p, artists a
        WHERE a.artist_id = p.artist_id
    """,
    "last_event_per_user": """
        SELECT userid, max(ts) AS last_ts FROM staging_events GROUP BY userid
    """,
    "latest_level_per_user": "SELECT * FROM latest",
    "plays_per_song_month": """
        SELECT song_id, title, artist_id, "name", "month", "year", count(*) AS plays
        FROM star GROUP BY ALL
    """,
    "plays_per_artist": """
        SELECT a.artist_id, a."name", count(*) AS plays
        FROM artists a
        JOIN songplays p ON p.artist_id = a.artist_id
        JOIN calendar c ON c.start_time = p.start_time
        GROUP BY ALL
    """,
    "epoch_to_timestamp": """
        SELECT event_id, epoch_us(ts) // 1000 AS epoch_ms,
               make_timestamp(epoch_us(ts) // 1000 * 1000) AS start_time
        FROM events
    """,
    "calendar_fields": DATES,
    "calendar_of_year": f'SELECT * FROM ({DATES}) WHERE "year" = 1998',
    "users": "SELECT * FROM users",
    "artists": "SELECT * FROM artists",
    "songs": "SELECT * FROM songs",
    "time_dim": "SELECT * FROM calendar",
    "songplays": "SELECT * FROM songplays",
    "songplays_with_id": NUMBERED,
    "top_songs": """
        SELECT song_id, title, artist_id, "name", "month", "year", count(*) AS plays
        FROM star WHERE "year" = 2024
        GROUP BY ALL
        ORDER BY plays DESC, song_id, "month", artist_id, title, "name" LIMIT 5
    """,
    "top_artists": """
        SELECT a.artist_id, a."name", count(*) AS plays
        FROM artists a
        JOIN songplays p ON p.artist_id = a.artist_id
        JOIN calendar c ON c.start_time = p.start_time
        WHERE c."year" = 2024
        GROUP BY ALL
        ORDER BY plays DESC, artist_id, "name" LIMIT 5
    """,
    "pipeline_counts": _counts("row_count", ALL_TABLES),
}


def oracle_sql() -> dict[str, str]:
    return {name: STAR + body for name, body in BODIES.items()}
