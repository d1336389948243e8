"""Every registered query against its SQL twin, over whole tables."""

import pytest

import __spark_entry__ as entry_points
from railpulse.checks import oracles
from railpulse.checks.queries import QUERIES
from tests.compare import bags, connect

ORACLES = oracles.oracle_sql()


@pytest.fixture(scope="module")
def con(sf001):
    return connect(sf001)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)
    assert set(ORACLES) <= set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, sf001, name):
    ours, theirs = bags(QUERIES[name](spark, sf001), con, ORACLES[name])
    assert ours, "no rows"
    extra, lacking = ours - theirs, theirs - ours
    assert not extra and not lacking, (
        sum(extra.values()), sum(lacking.values()), list(extra)[:3], list(lacking)[:3])
