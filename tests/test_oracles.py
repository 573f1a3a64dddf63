"""Every registered query against its SQL twin, on the whole of the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_point
from tidemart.plans.oracles import ORACLES
from tidemart.plans.registry import QUERIES
from tests.comparing import connect, normalised, spark_rows, sql_rows

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def database():
    return connect(SF_DIR)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_point.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, database, name):
    found = normalised(*spark_rows(entry_point.queries()[name](spark, SF_DIR)))
    expected = normalised(*sql_rows(database, entry_point.oracle_sql()[name]))
    assert found == expected
    assert found[1]


def test_entry_runs(spark):
    assert entry_point.entry(spark).count() == 30
