"""Listening analytics as PySpark DataFrame jobs.

JSON event logs and a song catalogue go in, a star schema (users, artists,
songs, time, songplays) and play-count reports come out.
"""

from encore.plans.pipeline import run_pipeline
from encore.plans.reports import top_artists, top_songs
from encore.sources.loaders import load_events, load_songs

__all__ = ["load_events", "load_songs", "run_pipeline", "top_artists", "top_songs"]
