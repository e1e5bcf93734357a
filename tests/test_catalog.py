"""Every catalog query against its SQL on the smallest tables."""

import pytest

import __spark_entry__
from codeledger import catalog as contract
from oracle import compare, connect

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_query_matches_sql(spark, duck, name):
    sql = contract.oracle_sql().get(name)
    assert sql, "every query has SQL"
    problem = compare(spark, duck, SF_DIR, contract.queries()[name], sql)
    assert problem is None, problem


def test_entry(spark):
    df = __spark_entry__.entry(spark)
    assert df.count() > 0 and "repo_id" in df.columns
