"""Every query with an SQL twin gives the same rows as that SQL."""

import pytest

from leadspark.plans.catalog import ORACLES, QUERIES
from tests.oracle import compare, duck


@pytest.fixture(scope="module")
def con(sf):
    return duck(sf)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, sf, con, name):
    diff, _, _ = compare(spark, name, sf, con)
    assert diff is None, diff


def test_registry_is_consistent():
    assert set(ORACLES) <= set(QUERIES)


def test_entry_points(spark):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert e.entry(spark).count() == 10
