import os

import pytest

import __spark_entry__ as contract
from checks.compare import compare, duck
from checks.oracles import ORACLES
from checks.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries()) and set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    df = contract.entry(spark)
    assert df.count() > 0 and "n_tokens" in df.columns


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, con, name):
    problem = compare(con, QUERIES[name](spark, SF_DIR), ORACLES[name])
    # some tables are too small here for a query to find anything
    assert problem in (None, "no rows")
