"""Every registered query against its SQL on the smallest tables."""

import re

import pytest

import __spark_entry__ as entry
from compare import compare, connect

SF = "/root/testdata/sf0.001"
# The training-data queries have their own tests.
OWN = {name: fn for name, fn in entry.queries().items() if not re.match(r"op\d+_|pipeline$", name)}
QUERIES, ORACLES = OWN, {name: sql for name, sql in entry.oracle_sql().items() if name in OWN}
LARGER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, con, name):
    problem = compare(spark, con, SF, name, QUERIES[name], ORACLES[name])
    if problem == "EMPTY":  # too few rows; an empty result proves nothing
        problem = compare(spark, connect(LARGER), LARGER, name, QUERIES[name], ORACLES[name])
    assert problem is None, problem


def test_entry(spark):
    assert entry.entry(spark).count() > 0
