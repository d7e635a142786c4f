"""Every registered query against its SQL, on whole tables."""

import os

import pytest
from compare import assert_same

import __spark_entry__ as driver
from encore.plans import registry

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = driver.queries(), driver.oracle_sql()


def test_every_query_has_sql():
    assert set(registry.queries()) <= set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    assert assert_same(QUERIES[name](spark, SF_DIR), SF_DIR, SQL[name]) > 0


def test_entry(spark):
    top = driver.entry(spark)
    assert top.columns == ["artist_id", "name", "plays"]
    assert top.count() == 4
