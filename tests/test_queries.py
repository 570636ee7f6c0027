"""Every registered query against its SQL on the smallest tables."""

import pytest
from oracle import compare, database

import __spark_entry__ as entries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return database(SF)


@pytest.mark.parametrize("name", sorted(entries.oracle_sql()))
def test_matches_sql(spark, connection, name):
    result = entries.queries()[name](spark, SF)
    assert compare(result, connection, entries.oracle_sql()[name]) == ""


def test_every_sql_has_a_query():
    assert set(entries.oracle_sql()) <= set(entries.queries())


def test_entry(spark):
    assert entries.entry(spark).count() > 0


def test_raw_schema_covers_all_fields(spark):
    [row] = entries.queries()["raw_schema"](spark, SF).collect()
    for name in ("event_data", "event_type", "id", "timestamp", "user_id", "outcome", "state"):
        assert f"{name}:" in row.merged_schema
