"""Every registered query gives what its SQL gives."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from changetrail.workloads import ORACLE_SQL, QUERIES
from tests.compare import duck, rows_of_duck, rows_of_spark


@pytest.fixture(scope="module")
def connection(sf_dir):
    return duck(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, connection, sf_dir, name):
    got = rows_of_spark(contract.queries()[name](spark, sf_dir))
    want = rows_of_duck(connection, contract.oracle_sql()[name])
    assert got[0] == want[0]
    assert got[1] == want[1]
    assert got[2] == want[2]
    assert got[2], "the query returns rows"


def test_entry(spark):
    assert contract.entry(spark).limit(1).count() == 1
