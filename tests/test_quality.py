"""Constraint checks."""

import pytest
from conftest import rows

from encore.operators import quality
from encore.schemas import SONGPLAYS, STAGING_EVENTS, USERS


@pytest.fixture
def people(spark):
    return spark.createDataFrame(
        [(1, "ann"), (1, "é" * 3), (2, None), (None, "")], "id int, name string"
    )


def test_not_null(people):
    assert rows(quality.not_null_violations(people, ["id", "name"])) == [("id", 1), ("name", 1)]


def test_width_counts_bytes(people):
    assert rows(quality.width_violations(people, {"name": 5})) == [("name", 1)]
    assert rows(quality.width_violations(people, {"name": 6})) == [("name", 0)]


def test_checks_of_an_empty_table_are_zero(people):
    none = people.where("id = 99")
    assert rows(quality.not_null_violations(none, ["id"])) == [("id", 0)]
    assert rows(quality.fk_violations(none, people, {"id": "id"})) == [(0,)]


def test_key(people):
    assert rows(quality.key_violations(people, ["id"])) == [(1, 2)]


def test_reference_ignores_null_and_counts_rows(spark, people):
    child = spark.createDataFrame([(1,), (7,), (7,), (None,)], "person int")
    assert rows(quality.fk_violations(child, people, {"person": "id"})) == [(2,)]


def test_reference_of_several_columns(spark):
    child = spark.createDataFrame([(1, "a"), (1, "b"), (1, None)], "x int, y string")
    parent = spark.createDataFrame([(1, "a")], "x int, z string")
    assert rows(quality.fk_violations(child, parent, {"x": "x", "y": "z"})) == [(1,)]


def test_enforce_stops_the_job(spark, make_events):
    fine = make_events({})
    assert rows(quality.enforce(fine, STAGING_EVENTS)) == rows(fine)
    with pytest.raises(Exception, match="staging_events.gender takes at most 1 bytes"):
        quality.enforce(make_events({"gender": "é"}), STAGING_EVENTS).collect()
    nobody = spark.createDataFrame([(None,)], "user_id int")
    with pytest.raises(Exception, match="users.user_id must not be NULL"):
        quality.enforce(nobody, USERS).collect()


def test_check_all(spark, make_events):
    plays = spark.createDataFrame([], SONGPLAYS.schema)
    found = quality.check_all({"staging_events": make_events({"level": "gold!"}), "songplays": plays})
    failed = rows(found.where("violations > 0"))
    assert failed == [("width", "staging_events", "level", 1)]
    assert {r[0] for r in rows(found, "check_name")} == {"width", "not null", "key"}


@pytest.mark.parametrize("row", [(None, "a", "b", "F", "free"), (1, "a", "b", "FF", "free")])
def test_enforce_fails_whatever_is_read(spark, row):
    table = USERS
    bad = quality.enforce(spark.createDataFrame([(1, "a", "b", "F", "free"), row], table.schema), table)
    for read in (lambda d: d.count(), lambda d: d.select("first_name").collect(), lambda d: d.collect()):
        with pytest.raises(Exception, match="users.(user_id must not be NULL|gender takes at most 1 bytes)"):
            read(bad)
