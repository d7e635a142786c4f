"""The command line on a small set of files."""

import json

import pytest

from conftest import rows

from encore.__main__ import deliver, execute, parser
from encore.sinks.layout import read_layout
from encore.sinks.store import TableStore


def put(folder, *records):
    folder.mkdir()
    (folder / "part.json").write_text("\n".join(json.dumps(r) for r in records))
    return str(folder)


def test_commands(spark, tmp_path):
    play = {"userId": "1", "artist": "A", "page": "NextSong", "sessionId": 2, "level": "free"}
    logs = put(tmp_path / "logs", {**play, "ts": 1514764800000}, {**play, "ts": 1514764800001})
    song = {"song_id": "S1", "title": "T", "artist_id": "X", "artist_name": "A", "year": 0}
    songs = put(tmp_path / "songs", song, {**song, "song_id": "S2"})
    out = str(tmp_path / "tables")

    def run(*words):
        return execute(spark, parser().parse_args(words))

    files = ("--logs", logs, "--songs", songs)
    run("create", out)
    assert run("check", out).where("violations > 0").count() == 0
    run("etl", out, *files)
    assert rows(run("top-artists", out, "--year", "2018")) == [("X", "A", 4)]
    assert rows(run("top-songs", out, "--year", "2018", "--top", "1"), "song_id", "plays") == [("S1", 2)]
    run("etl", out, *files)
    assert TableStore(spark, out).read("users").count() == 2
    assert rows(run("check", out).where("violations > 0"), "check_name", "table_name")[0] == ("key", "artists")
    run("run", out, *files)
    query = "SELECT month, count(*) AS n FROM songplays JOIN time USING (start_time) GROUP BY month"
    assert rows(run("sql", out, query, "--to", "unused")) == [(1, 4)]
    run("layout", out, "--buckets", "2", "--database", "cli_layouts")
    assert read_layout(spark, "cli_layouts.songplays").count() == 4
    found = run("top-artists", out, "--year", "2018", "--database", "cli_layouts")
    assert rows(found) == [("X", "A", 4)]


def test_whole_results_are_written(spark, tmp_path):
    args = parser().parse_args(["sql", "unused", "unused", "--to", str(tmp_path / "all"), "--format", "json"])
    deliver(spark.range(1234), args)
    assert spark.read.json(str(tmp_path / "all")).count() == 1234
    with pytest.raises(SystemExit):
        parser().parse_args(["sql", "unused", "unused"])
