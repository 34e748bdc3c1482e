"""Queries that SQL can express equal their SQL; the others are tested beside their operators."""

import pytest

import oracle
from keypanel.llm.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, name):
    assert oracle.compare(spark, oracle.connect(SF), QUERIES[name], SQL[name], SF) == []


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == [*range(1, 14)]
