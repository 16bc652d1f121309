"""Every registered query against its SQL counterpart."""

import pytest
from compare import connect, differences

import __spark_entry__ as entry_points
from catalog.oracles import ORACLES
from catalog.queries import QUERIES as OWN_QUERIES

SF_DIR = "/root/testdata/sf0.001"
# In the smallest tables no route has more than one flight a month, and no flight leaves "NCX".
MAY_BE_EMPTY = {"min_volume", "route_pick"}
QUERIES = {name: query for name, query in entry_points.queries().items() if name in OWN_QUERIES}


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_a_counterpart():
    assert set(QUERIES) == set(OWN_QUERIES) == set(ORACLES)
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, duck, name):
    found = differences(QUERIES[name](spark, SF_DIR), duck, ORACLES[name], name in MAY_BE_EMPTY)
    assert found == []


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
