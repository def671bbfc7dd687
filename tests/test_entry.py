"""Every registered query against its SQL at the smallest scale."""

import pytest

import __spark_entry__ as entry
from testbed.queries import registry
from testbed.compare import connect, difference

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(registry()))
def test_query_matches_its_sql(spark, con, name):
    assert difference(spark, con, SF_DIR, name) is None


def test_flagship(spark):
    assert entry.entry(spark).count() > 0


def test_every_query_has_an_oracle():
    assert set(registry()) <= set(entry.queries())
    assert set(registry()) <= set(entry.oracle_sql())
