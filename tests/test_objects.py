"""Cutting files into JSON objects: ranges of large files, places, linear time."""

import json
import random
import re
import time

import numpy as np
import pyarrow as pa
import pytest
from conftest import rows
from pyspark.sql import Observation
from test_loaders import EVENT, SONG, put

from encore.schemas import STAGING_EVENTS, STAGING_SONGS
from encore.sources.loaders import LINES, QUARANTINE, bad_records, load_events, load_songs, read_documents, read_lines
from encore.sources.objects import _Cutter, braces, depths


def plain_pieces(text: str, by_line: bool = False) -> list[tuple[str, int]]:
    """Pieces with their line, one character after the other."""
    found, now, depth, began = [], "", 0, 1

    def end():
        nonlocal now
        if now.strip(" \t\n\x0b\x0c\r"):
            found.append((now.strip(" \t\n\x0b\x0c\r"), began))
        now = ""

    for number, line in enumerate(text.split("\n"), 1):
        at, strings = 0, True
        while at < len(line):
            string = re.compile(r'"(?:[^"\\]|\\.)*"').match(line, at) if line[at] == '"' and strings else None
            strings = strings and (string is not None or line[at] != '"')
            piece = string.group() if string else line[at]
            at += len(piece)
            if piece == "{" and depth == 0:
                end()
            began = number if not now.strip() else began
            now += piece
            depth = max(depth + {"{": 1, "}": -1}.get(piece, 0), 0)
            if piece == "}" and depth == 0:
                end()
        if depth == 0 or by_line:
            end()
            depth = 0
        now += "\n" if now else ""
    end()
    return found


def cut(texts: list[str], by_line: bool, batch: int = 3) -> list[tuple[str, int]]:
    lines = "\n".join(texts).split("\n")
    n = len(lines)
    table = pa.table({
        "value": lines, "file": ["f"] * n, "a": np.zeros(n, np.int64), "b": np.full(n, 9), "c": np.full(n, 9),
    })
    found = [b.to_pydict() for b in _Cutter(by_line)(iter(table.to_batches(max_chunksize=batch)))]
    return [(v, k) for f in found for v, k in zip(f["value"], f["line"], strict=True)]


SCRAPS = ['{"a": 1}', '{"b": {"c": "}"}}', '{"d":\n [1,\n {"e": 2}\n]}', "{", "}", '"', '\\"', "text", " ", "\n", '"{"', '{"f\\"": "\\\\"}', "ü"]


@pytest.mark.parametrize("seed", range(40))
def test_pieces_of_any_text(seed):
    rng = random.Random(seed)
    texts = ["".join(rng.choice(SCRAPS) for _ in range(rng.randrange(12))) for _ in range(8)]
    for by_line in (True, False):
        want = plain_pieces("\n".join(texts), by_line)
        assert cut(texts, by_line) == want
        assert cut(texts, by_line, batch=100) == want


def test_depths_never_go_below_zero_and_start_anew_in_each_group():
    step = np.array([1, -1, -1, 1, 1, -1, -1, -1, 1])
    group = np.array([0, 0, 0, 0, 1, 1, 1, 1, 2])
    assert depths(step, group, np.array([0, 2, 0])).tolist() == [1, 0, 0, 1, 3, 2, 1, 0, 1]


def test_escapes_and_open_strings():
    line = rb'{"a\\": "{", "b\"}": 1} "open {'
    text = np.frombuffer(line + b"\n", np.uint8)
    assert braces(text, np.array([len(line)])).tolist() == [0, 22, len(line) - 1]


def catalogue(folder, n, broken=False):
    """A pretty-printed file of ``n`` songs, one of them much longer than a range of 4 kB."""
    songs = [{**SONG, "song_id": f"SO{k}", "title": f"T {{ {k}" * (1 + k % 7)} for k in range(n)]
    songs[n // 2]["ignored"] = ["x" * 70] * 300
    texts = [json.dumps(s, indent=1 + k % 4) for k, s in enumerate(songs)]
    if broken:
        texts[n // 3] += "\n} beside\n"
        texts[-1] = texts[-1][:-1]
    folder.mkdir()
    (folder / "all.json").write_text("\n".join(texts[: n // 4]) + "".join(texts[n // 4 :]))
    (folder / "small.json").write_text(json.dumps({**SONG, "song_id": "small"}))
    return str(folder)


@pytest.fixture
def small_ranges(spark):
    sizes = {"spark.sql.files.maxPartitionBytes": "4096", "spark.sql.files.openCostInBytes": "512"}

    def switch(on):
        for key, value in sizes.items():
            spark.conf.set(key, value) if on else spark.conf.unset(key)

    yield switch
    switch(False)


@pytest.mark.parametrize("broken", [False, True])
def test_ranges_give_the_rows_of_whole_files(spark, tmp_path, small_ranges, broken):
    path = catalogue(tmp_path / "songs", 300, broken)
    whole = rows(read_documents(spark, path), "value")
    bad = rows(bad_records(read_documents(spark, path), STAGING_SONGS), "value", "reason")
    assert len(bad) == (3 if broken else 0)
    small_ranges(True)
    read = read_documents(spark, path)
    assert spark.read.text(path).rdd.getNumPartitions() > 20
    assert rows(read, "value") == whole
    assert rows(bad_records(read, STAGING_SONGS), "value", "reason") == bad
    assert load_songs(spark, path, QUARANTINE).count() == 301 - broken
    places = read.select("file", "from_byte", "line").collect()
    assert len({r["from_byte"] for r in places}) > 15 and all(r["line"] >= 1 for r in places)


def test_a_place_leads_to_the_record(spark, tmp_path, small_ranges):
    path = catalogue(tmp_path / "songs", 60)
    small_ranges(True)
    text = (tmp_path / "songs" / "all.json").read_bytes()
    for r in read_documents(spark, path).where("file like '%/all.json'").collect():
        begin = 0 if r["from_byte"] == 0 else text.index(b"\n", r["from_byte"]) + 1
        line = text[begin:].split(b"\n")[r["line"] - 1].decode()
        assert r["value"].split("\n")[0].strip() in line


def test_bad_records_have_a_place(spark, tmp_path):
    put(tmp_path, "d/a.json", EVENT, "", '{"gender": "FEMALE"}', EVENT, "beside")
    put(tmp_path, "b.json", '{"userId": "x"} {"ts": "y"}')
    found = bad_records(read_lines(spark, str(tmp_path)), STAGING_EVENTS).collect()
    places = sorted((r["file"].rsplit("/", 1)[1], r["from_byte"], r["line"], r["reason"]) for r in found)
    assert places == [
        ("a.json", 0, 3, "width of gender"), ("a.json", 0, 5, "not json"),
        ("b.json", 0, 1, "type of ts"), ("b.json", 0, 1, "type of userid"),
    ]
    with pytest.raises(Exception, match=r"bad record for staging_events: .* in file:.*\.json from byte 0, line \d"):
        load_events(spark, str(tmp_path)).count()


def test_quarantine_counts_what_it_leaves_out_in_the_same_job(spark, tmp_path):
    path = put(tmp_path / "in", "a.json", EVENT, "beside", EVENT, '{"ts": "y"}', EVENT)
    counts = Observation()
    load_events(spark, path, QUARANTINE, counts).write.parquet(str(tmp_path / "out"))
    assert counts.get == {"read": 5, "left_out": 2}


def test_a_record_is_parsed_once(spark, tmp_path):
    put(tmp_path, "a.json", SONG, EVENT)
    for rows_of in (load_events(spark, str(tmp_path)), load_songs(spark, str(tmp_path), layout=LINES)):
        for df in (rows_of, rows_of.select(rows_of.columns[0]), rows_of.groupBy().count()):
            assert df._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1


def test_linear_in_the_number_of_objects():
    def seconds(n):
        line = " ".join(['{"userId": "1", "song": "a } b"}'] * n)
        best = np.inf
        for _ in range(3):
            began = time.perf_counter()
            assert len(cut([line], True)) == n
            best = min(best, time.perf_counter() - began)
        return best

    assert seconds(160_000) < 25 * seconds(16_000)
