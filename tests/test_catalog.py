"""Every named query against its SQL on the sample tables."""

import functools

import __spark_entry__ as entry_points
import oracle
import pytest
from riskloom.catalog import ORACLES
from riskloom.catalog import QUERIES as NAMED

SQL = ORACLES
QUERIES = {name: query for name, query in entry_points.queries().items() if name in NAMED}


@functools.cache
def connection():
    return oracle.connect()


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)
    assert set(SQL) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, name):
    table = QUERIES[name](spark, oracle.SAMPLE_DIR).toArrow()
    assert oracle.difference(connection(), table, SQL[name]) is None


def test_flagship(spark):
    assert entry_points.entry(spark).count() > 0
