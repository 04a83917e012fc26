"""Every registered query on the small tables, against its SQL twin where it has one."""

import pytest
from conftest import SMALL
from oracle import compare, connect

from millrace.plans import ORACLES, QUERIES


@pytest.fixture(scope="module")
def connection():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, connection, name):
    verdict, _ = compare(spark, connection, SMALL, QUERIES[name], ORACLES[name])
    assert verdict == "exact"


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(spark, name):
    assert not QUERIES[name](spark, SMALL).isEmpty()


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
