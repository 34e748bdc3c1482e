"""Every registered query equals its SQL."""

import pytest

import __spark_entry__ as entry
import workload
import oracle

SF = "/root/testdata/sf0.001"
QUERIES, SQL = workload.QUERIES, workload.SQL


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF)


def test_every_query_is_checked():
    assert set(SQL) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert oracle.compare(spark, con, QUERIES[name], SQL[name], SF) == []


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[:2] == ["n_name", "year"] and df.count() > 0
