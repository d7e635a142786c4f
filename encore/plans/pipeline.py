"""The whole job: files to staging tables to star schema."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from encore.operators.dimensions import build_artists, build_songs, build_time, build_users
from encore.operators.facts import RANGE, numbered_songplays
from encore.operators.quality import enforce
from encore.plans.reports import month_counts
from encore.schemas import PLAYS_BY_MONTH, TABLES
from encore.scratch import discard
from encore.sinks.store import TableStore, by_name, by_position
from encore.sources.loaders import DOCUMENTS, STRICT, load_events, load_songs

OVERWRITE = "overwrite"
APPEND = "append"


def load_staging(
    store: TableStore,
    log_path: str,
    song_path: str,
    on_bad_record: str = STRICT,
    songs_format: str = DOCUMENTS,
) -> dict[str, dict[str, int]]:
    """Append the files to the two staging tables.

    Returns how many records each read and how many it left out, counted by the writing jobs.
    """
    found = {}
    for name, load in {
        "staging_events": lambda counts: load_events(store.spark, log_path, on_bad_record, counts),
        "staging_songs": lambda counts: load_songs(store.spark, song_path, on_bad_record, songs_format, counts),
    }.items():
        counts = Observation()
        store.append(name, load(counts))
        found[name] = counts.get
    return found


def insert_dimensions(store: TableStore) -> None:
    """Append users, artists, songs and time, built from staging."""
    events, songs = store.read("staging_events"), store.read("staging_songs")
    for name, rows in {
        "users": build_users(events),
        "artists": build_artists(songs),
        "songs": build_songs(songs),
        "time": build_time(events),
    }.items():
        table = TABLES[name]
        store.append(name, enforce(by_position(rows, table), table))


def insert_songplays(store: TableStore) -> None:
    """Append the fact, built from staged events and the stored dimensions, and count its plays.

    Ids go on after the largest one stored, which the store notes, so stored rows are not read for it.
    """
    table = TABLES["songplays"]
    last = store.note(table.name).get("last_id")
    if last is None:
        last = store.read(table.name).agg(F.max("songplay_id")).first()[0]
    last = -1 if last is None else last
    numbered, staged = numbered_songplays(
        store.read("staging_events"), store.read("artists"), store.read("songs"), start=last + 1
    )
    written = Observation()
    try:
        # By ranges of time, as the table declares, and sorted in each file; a range that a
        # hot artist fills is split.
        placed = enforce(numbered, table).hint("rebalance", RANGE).sortWithinPartitions("start_time")
        placed = by_name(placed, table).observe(written, F.max("songplay_id").alias("last_id"))
        with store.change():
            store.append(table.name, placed)
            now = written.get["last_id"]
            store.take_note(table.name, last_id=last if now is None else now)
            count_plays_by_month(store)
    finally:
        for path in staged:
            discard(store.spark, path)


def count_plays_by_month(store: TableStore) -> None:
    """Bring ``plays_by_month`` up to date by what fact and calendar have more than when it was last.

    New fact rows meet the whole calendar, and older ones only its new rows, pruned by their
    range of time. If rows it was made from are gone, it is made anew.
    """
    name = PLAYS_BY_MONTH.name
    now = {t: store.parts(t) for t in ("songplays", "time")}
    note = store.note(name)
    known = {t: note.get(f"parts of {t}", []) for t in now}
    if any(set(known[t]) - set(now[t]) for t in now):
        known = {t: [] for t in now}
    fresh = {t: [p for p in now[t] if p not in known[t]] for t in now}
    counts = month_counts(store.read("songplays", fresh["songplays"]), store.read("time"))
    if known["songplays"] and fresh["time"]:
        added = store.read("time", fresh["time"])
        first, last = added.agg(F.min("start_time"), F.max("start_time")).first()
        older = store.read("songplays", known["songplays"])
        if first is not None:
            counts = counts.unionByName(month_counts(older.where(F.col("start_time").between(first, last)), added))
    with store.change():
        rows = by_name(counts, PLAYS_BY_MONTH)
        store.append(name, rows) if known["songplays"] or known["time"] else store.overwrite(name, rows)
        store.take_note(name, **{f"parts of {t}": parts for t, parts in now.items()})


def stored_month_counts(store: TableStore) -> DataFrame | None:
    """``plays_by_month``, summed over its inserts, if it is up to date."""
    note = store.note(PLAYS_BY_MONTH.name)
    if any(set(note.get(f"parts of {t}", [])) != set(store.parts(t)) for t in ("songplays", "time")):
        return None
    keys = [c for c in PLAYS_BY_MONTH.names if c != "plays"]
    return store.read(PLAYS_BY_MONTH.name).groupBy(*keys).agg(F.sum("plays").alias("plays"))


def run_pipeline(
    spark: SparkSession,
    log_path: str,
    song_path: str,
    out: str,
    mode: str = OVERWRITE,
    on_bad_record: str = STRICT,
    songs_format: str = DOCUMENTS,
    told: Callable[[dict[str, dict[str, int]]], None] = lambda counts: None,
) -> TableStore:
    """Fill the seven tables under ``out`` and return them.

    ``overwrite`` starts from empty tables, so reruns give the same tables.
    ``append`` adds to what is there: staged rows double on a rerun and every
    dimension is inserted again. Either way all tables change together at the end; a run that
    fails leaves them as they were. ``told`` gets the counts of ``load_staging``.
    """
    if mode not in (OVERWRITE, APPEND):
        raise ValueError(f"unknown mode {mode!r}")
    store = TableStore(spark, out)
    with store.change():
        if mode == OVERWRITE:
            store.rebuild()
        else:
            store.create_missing()
        counts = load_staging(store, log_path, song_path, on_bad_record, songs_format)
        insert_dimensions(store)
        insert_songplays(store)
    told(counts)
    return store
