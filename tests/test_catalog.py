from __future__ import annotations

import pytest

import __spark_entry__ as contract
import bench
import oracle
from cardwarden.plans import catalog

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return oracle.connect(SF)


def test_every_query_has_sql():
    assert set(catalog.QUERIES) == set(catalog.ORACLE)
    assert set(catalog.QUERIES) <= set(contract.queries())


def test_benchmark_times_registered_queries():
    assert set(bench.HEADLINE) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_matches_its_sql(spark, duck, name):
    df = contract.queries()[name](spark, SF)
    assert oracle.difference(df, duck, contract.oracle_sql()[name]) is None
