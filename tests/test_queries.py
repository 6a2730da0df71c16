"""Every registered query against its SQL, on the smallest tables."""

import pytest

from tests.oracle import connect, difference
from workload import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, con, sf_dir, name):
    assert difference(spark, con, QUERIES[name], ORACLES[name], sf_dir) is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
