"""JSON files to staging rows."""

import json
from decimal import Decimal

import pytest
from conftest import rows

from encore.schemas import STAGING_EVENTS, STAGING_SONGS
from encore.sources import crosswalk
from encore.sources.loaders import (
    LINES,
    QUARANTINE,
    _number,
    bad_records,
    load_events,
    load_songs,
    read_lines,
)
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

# The keys of both kinds of records. What they hold is made up.
EVENT = {
    "artist": "The Made Ups", "auth": "Logged In", "firstName": "Ada", "gender": "F",
    "itemInSession": 3, "lastName": "Quill", "length": 101.222229, "level": "paid",
    "location": "Nowhere", "method": "PUT", "page": "NextSong", "registration": 1500000000000.0,
    "sessionId": 17, "song": "Song of Tests", "status": 200, "ts": 1525132800000,
    "userAgent": '"Agent/1.0 {x}"', "userId": "8",
}
SONG = {
    "num_songs": 1, "artist_id": "AR1", "artist_latitude": None, "artist_longitude": -1.5,
    "artist_location": "", "artist_name": "Line", "song_id": "SO1", "title": "Zwei {\"} {\" Zwerge",
    "duration": 99.00009, "year": 0,
}


def put(folder, name, *lines):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(x if isinstance(x, str) else json.dumps(x) for x in lines))
    return str(folder)


def test_event_fields(spark, tmp_path):
    row = load_events(spark, put(tmp_path, "a.json", EVENT)).first().asDict()
    assert row == {
        **{k.lower(): v for k, v in EVENT.items()},
        "userid": 8, "length": Decimal("101.22222"), "registration": Decimal(1500000000000),
    }


def test_empty_user_id_is_null_and_empty_text_stays(spark, tmp_path):
    path = put(tmp_path, "a.json", {**EVENT, "userId": "", "length": "", "location": ""})
    assert rows(load_events(spark, path), "userid", "length", "location") == [(None, None, "")]


def test_keys_match_ignoring_case(spark, tmp_path):
    lines = [
        {"USERID": "1", "firstname": "Ann", "unknown": {"a": [1]}},
        {"userId": 2, "FirstName": "Bo"},
        {"userid": "3", "USERID": "4"},
    ]
    path = put(tmp_path, "a.json", *lines)
    found = rows(load_events(spark, path), "userid", "firstname", "artist")
    assert found == [(1, "Ann", None), (2, "Bo", None), (4, None, None)]


def test_files_at_any_depth_are_read(spark, tmp_path):
    put(tmp_path, "2018/11/a.json", EVENT)
    put(tmp_path, "b.json", EVENT, "", "  ", EVENT)
    assert load_events(spark, str(tmp_path)).count() == 3


def test_bad_line_aborts_a_strict_load(spark, tmp_path):
    path = put(tmp_path, "a.json", EVENT, '{"userId": "1"')
    with pytest.raises(Exception, match="bad record .*not json"):
        load_events(spark, path).collect()


@pytest.mark.parametrize(
    "broken, reason",
    [
        ('{"userId": "1"', "not json"),
        ("[1, 2]", "not json"),
        ('"text"', "not json"),
        ('{"userId": "eight"}', "type of userid"),
        ('{"length": 123456.0}', "type of length"),
        ('{"gender": "FEMALE"}', "width of gender"),
        ('{"level": "ééé"}', "width of level"),
    ],
)
def test_bad_records(spark, tmp_path, broken, reason):
    path = put(tmp_path, "a.json", EVENT, broken)
    found = bad_records(read_lines(spark, path), STAGING_EVENTS).select("value", "reason")
    assert rows(found) == [(broken, reason)]
    assert rows(load_events(spark, path, QUARANTINE), "userid") == [(8,)]
    with pytest.raises(Exception):
        load_events(spark, path).collect()


@pytest.mark.parametrize(
    "text, cut",
    [
        ("731.415926", "731.41592"), ("-731.415929", "-731.41592"), ("99999.999999", "99999.99999"),
        ("1.00000999999999999999999999999999", "1.00000"), ("1.234567E1", "12.34567"), ("-0.000009", "0.00000"),
        ("7", "7.00000"),
    ],
)
def test_decimals_are_cut_not_rounded(spark, tmp_path, text, cut):
    path = put(tmp_path, "a.json", f'{{"length": "{text}", "registration": "1.9"}}')
    assert rows(load_events(spark, path), "length", "registration") == [(Decimal(cut), Decimal(1))]


def test_several_objects_on_a_line(spark, tmp_path):
    lines = ['{"userId":"1"} {"userId":"2"}', '{"userId":"3"}{"userId":"4","song":"} {"}', '  {"userId":"5"}  ']
    path = put(tmp_path, "a.json", *lines)
    assert [r[0] for r in rows(load_events(spark, path), "userid")] == [1, 2, 3, 4, 5]


@pytest.mark.parametrize(
    "line, left",
    [
        ('{"userId":"1"} garbage', ["garbage"]),
        ('garbage {"userId":"1"}', ["garbage"]),
        ('{"userId":"1"}}', ["}"]),
        ('{"userId":"1"} {"userId"', ['{"userId"']),
        ('{"userId":"1"} "text', ['"text']),
    ],
)
def test_text_beside_objects_is_a_bad_record(spark, tmp_path, line, left):
    path = put(tmp_path, "a.json", line)
    assert [r.value for r in bad_records(read_lines(spark, path), STAGING_EVENTS).collect()] == left
    assert rows(load_events(spark, path, QUARANTINE), "userid") == [(1,)]
    with pytest.raises(Exception, match="bad record"):
        load_events(spark, path).collect()


@pytest.mark.parametrize("bad", ['{"page": "x"', '{"userId": "x"}', '{"gender": "FEMALE"}'])
def test_strict_loads_fail_whatever_is_read(spark, tmp_path, bad):
    path = put(tmp_path, "a.json", EVENT, bad)
    for read in (lambda d: d.count(), lambda d: d.select("page").collect()):
        with pytest.raises(Exception, match="bad record"):
            read(load_events(spark, path))


def test_songs_as_lines(spark, tmp_path):
    put(tmp_path, "a.json", {**SONG, "song_id": "SO1"}, json.dumps(SONG) + json.dumps({**SONG, "song_id": "SO2"}))
    found = load_songs(spark, str(tmp_path), layout=LINES)
    assert [r[0] for r in rows(found, "song_id")] == ["SO1", "SO1", "SO2"]


def test_song_documents(spark, tmp_path):
    put(tmp_path, "A/B/one.json", json.dumps(SONG, indent=4))
    put(tmp_path, "A/C/two.json", {**SONG, "song_id": "SO2"})
    put(tmp_path, "D/many.json", json.dumps({**SONG, "song_id": "SO3"}, indent=2), "",
        {**SONG, "song_id": "SO4"}, {**SONG, "song_id": "SO5"})
    found = load_songs(spark, str(tmp_path))
    assert [r[0] for r in rows(found, "song_id")] == ["SO1", "SO2", "SO3", "SO4", "SO5"]
    first = found.where("song_id = 'SO1'").first().asDict()
    assert first == {
        **SONG, "artist_longitude": Decimal("-1.50000"), "duration": Decimal("99.00009"),
    }


def test_bad_document_aborts_a_strict_load(spark, tmp_path):
    path = put(tmp_path, "a.json", json.dumps(SONG, indent=4)[:-2])
    with pytest.raises(Exception, match="bad record .*not json"):
        load_songs(spark, path).collect()
    assert load_songs(spark, path, QUARANTINE).count() == 0


def test_files_of_the_test_tables_are_written_without_a_shuffle_of_their_text(spark, tmp_path, monkeypatch):
    plans, text = [], DataFrameWriter.text

    def noted(self, *args, **kwargs):
        plans.append(self._df._jdf.queryExecution().executedPlan().toString())
        return text(self, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "text", noted)
    crosswalk.write_logs(spark, "/root/testdata/sf0.001", f"{tmp_path}/logs")
    crosswalk.write_catalogue(spark, "/root/testdata/sf0.001", f"{tmp_path}/songs")
    above = [p[: p.index("Join")] for p in plans]  # what comes after the rows are joined
    assert len(above) == 2 and not any("Exchange" in p or "Aggregate" in p for p in above)
    for path, count in (("logs", 1000), ("songs", 6000)):
        lines = [x for x in spark.read.option("recursiveFileLookup", "true").text(f"{tmp_path}/{path}").toPandas()["value"] if x.strip()]
        assert len(lines) < count  # some hold two objects
        assert read_lines(spark, f"{tmp_path}/{path}").count() == count


def test_decimals_of_any_spelling_are_cut_toward_zero(spark):
    texts = ["1.5", "-1.5", " 2.12345 ", "-0.000019", "\t-1.234567", "12E-7", "-1234567E-6", "1e3", "", "-.999999", "7", "1.123456x", "12345678"]
    cut = ["1.50000", "-1.50000", "2.12345", "-0.00001", "-1.23456", "0.00000", "-1.23456", "1000.00000", None, "-0.99999", "7.00000", None, None]
    kind = {c.name: c.type for c in STAGING_SONGS.columns}["duration"]
    found = spark.createDataFrame(list(enumerate(texts)), "k int, t string").orderBy("k").select(_number(F.col("t"), kind).try_cast(kind))
    assert [r[0] if r[0] is None else f"{r[0]:.5f}" for r in found.collect()] == cut


def test_files_of_the_test_tables_are_packed_with_few_rows_each(spark, tmp_path, monkeypatch):
    """As plain text they took ten times the disk of the tables."""
    monkeypatch.setitem(crosswalk.PACKED, "maxRecordsPerFile", 1000)
    crosswalk.write_logs(spark, "/root/testdata/sf0.001", f"{tmp_path}/logs")
    crosswalk.write_catalogue(spark, "/root/testdata/sf0.001", f"{tmp_path}/songs")
    songs = [p for p in (tmp_path / "songs").rglob("part-*")]
    assert len(songs) >= 6
    for path, load, made in (("logs", load_events, crosswalk.staging_events), ("songs", load_songs, crosswalk.staging_songs)):
        size = sum(p.stat().st_size for p in (tmp_path / path).rglob("part-*"))
        text = spark.read.option("recursiveFileLookup", "true").text(f"{tmp_path}/{path}")
        assert size < text.agg(F.sum(F.octet_length("value"))).first()[0] / 3
        want = made(spark, "/root/testdata/sf0.001")
        got = load(spark, f"{tmp_path}/{path}").select(*want.columns)
        assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
