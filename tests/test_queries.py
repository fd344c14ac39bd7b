"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import pytest
from compare import compare, database

import __spark_entry__ as entry

#: Queries whose condition nothing fulfils in the smallest tables.
MAY_BE_EMPTY: set[str] = set()
FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return database(FOLDER)


@pytest.mark.parametrize("name", list(entry.oracle_sql()))
def test_query_agrees_with_sql(spark, con, name):
    result = compare(spark, con, name, entry.queries()[name], entry.oracle_sql()[name], FOLDER)
    assert result is None or (result == "no rows" and name in MAY_BE_EMPTY)


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.oracle_sql())))
def test_query_without_sql_runs(spark, name):
    rows = entry.queries()[name](spark, FOLDER).count()
    assert rows > 0


def test_entry(spark):
    weeks = entry.entry(spark)
    assert weeks.columns == ["week", "events", "surgical_events", "other_events"]
    assert weeks.filter("events <> surgical_events + other_events").count() == 0
