import os

import pytest
from check_oracles import compare, connect

from __spark_entry__ import entry, oracle_sql, queries
from workload.oracles import ORACLES
from workload.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(ORACLES) <= set(oracle_sql()) <= set(queries())


def test_entry(spark):
    df = entry(spark)
    assert df.columns == [
        "branch_id",
        "avg_rating",
        "total_ratings",
        "branch_name",
        "num_active_employees",
    ]
    assert df.count() == 6


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_its_sql(spark, con, name):
    assert compare(queries()[name](spark, SF_DIR), con, oracle_sql()[name]) == ""
