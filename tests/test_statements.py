"""Every named query against its independent SQL statement."""

from __future__ import annotations

import pytest
from compare import connect, difference

from oracle import statements
from sojourn.plans.catalog import QUERIES

SF_DIR = "/root/testdata/sf0.001"
SQL = statements()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_a_statement():
    assert set(SQL) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_statement(spark, con, name):
    assert difference(QUERIES[name](spark, SF_DIR), con, SQL[name]) is None
