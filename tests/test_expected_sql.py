"""Every registered query against its SQL on the small test data."""

import __spark_entry__ as entry
import pytest
from check import connect, difference
from conftest import SMALL

EXPECTED = entry.oracle_sql()
RUNS = entry.queries()


@pytest.fixture(scope="module")
def database():
    return connect(SMALL)


def test_every_expected_query_is_registered():
    assert set(EXPECTED) <= set(RUNS)


@pytest.mark.parametrize("name", sorted(EXPECTED))
def test_matches_sql(spark, database, name):
    assert difference(RUNS[name](spark, SMALL), database, EXPECTED[name]) is None


def test_flagship_runs(spark):
    assert entry.entry(spark).count() == 112
