"""Every query against its SQL on an independent engine, over the same tables."""

import pytest

import __spark_entry__ as entry
from casemart.plans.oracle import all_oracles
from casemart.plans.queries import all_queries
from compare import compare, connect

QUERIES, ORACLES = all_queries(), all_oracles()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = connect(sf_dir)
    yield con
    con.close()


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_the_oracle(spark, sf_dir, duck, name):
    assert compare(QUERIES[name](spark, sf_dir), duck, ORACLES[name]) == ""


def test_entry_runs(spark):
    out = entry.entry(spark)
    assert out.count() == 26 and "provincia_nombre" in out.columns
