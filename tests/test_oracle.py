"""Every query against its SQL on the smallest test tables."""

import os

import pytest

import __spark_entry__ as entry
from check_oracle import compare, connect
from workload import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not there")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    result, _ = compare(spark, con, name, SF_DIR, QUERIES, ORACLES)
    assert result.startswith("ok"), result


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["cell", "time", "value"]
    assert df.count() > 0
