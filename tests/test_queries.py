"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
import workload
from tools.compare import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_sql():
    assert set(workload.QUERIES) == set(workload.ORACLE)


@pytest.mark.parametrize("name", sorted(workload.QUERIES))
def test_query(spark, con, name):
    ok, text = compare(spark, con, name, SF)
    assert ok, text


def test_entry(spark):
    assert entry.entry(spark).count() == 400
