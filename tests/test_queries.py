"""Every registered query next to its SQL, at the smallest scale."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from feedmart.oracles import ORACLES
from feedmart.queries import QUERIES
from tests.compare import differences, warehouse

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return warehouse(SF)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)
    assert QUERIES.items() <= queries().items() and ORACLES.items() <= oracle_sql().items()


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, db, name):
    assert differences(QUERIES[name](spark, SF), db, ORACLES[name]) == []
