"""Every registered query against its SQL twin; the others must return rows."""

import pytest
from compare import connect, differences

from flowlake.plans import catalog

QUERIES, ORACLES = catalog.queries(), catalog.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_twin_has_a_query():
    assert ORACLES.keys() <= QUERIES.keys()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, con, sf_dir, name):
    assert differences(spark, con, name, QUERIES[name], ORACLES[name], sf_dir) is None


@pytest.mark.parametrize("name", sorted(QUERIES.keys() - ORACLES.keys()))
def test_returns_rows(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).limit(1).count() == 1
