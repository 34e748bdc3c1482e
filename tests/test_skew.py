"""Tables in which one key, id, source or group of copies holds a third of all rows."""

import duckdb
import pytest

import workload
import oracle
from keypanel.operators import joins, quantiles

SF = "/root/testdata/sf0.001"
QUERIES, SQL = workload.QUERIES, workload.SQL

HOT = {
    "lineitem": ("l_orderkey, l_partkey, l_extendedprice",
                 {"l_orderkey": "7", "l_suppkey": "3", "l_linenumber": "1", "l_quantity": "20"}),
    "orders": ("o_orderkey", {"o_orderkey": "7", "o_custkey": "11", "o_orderpriority": "'5-LOW'"}),
    "documents": ("doc_id", {"doc_id": "5", "source": "'src0'", "text": "repeat('one text ', 500)"}),
    "customer": ("c_custkey", {"c_nationkey": "4", "c_mktsegment": "'BUILDING'"}),
    "part": ("p_partkey", {"p_name": "'red plate'", "p_size": "7"}),
}


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    folder = tmp_path_factory.mktemp("skewed")
    con = duckdb.connect()
    for name in oracle.TABLES:
        source = f"'{SF}/{name}.parquet'"
        if name in HOT:
            ids, values = HOT[name]
            replaced = ", ".join(
                f"CAST(CASE WHEN hash({ids}) % 3 = 0 THEN {v} ELSE {c} END AS "
                f"{con.execute(f'SELECT typeof({c}) FROM {source}').fetchone()[0]}) AS {c}" for c, v in values.items())
            con.execute(f"COPY (SELECT * REPLACE ({replaced}) FROM {source}) TO '{folder}/{name}.parquet'")
        else:
            con.execute(f"COPY (SELECT * FROM {source}) TO '{folder}/{name}.parquet'")
    return str(folder)


@pytest.fixture
def small_limits(monkeypatch):
    """Treat ids apart and narrow ranges from a few rows on, as for large tables."""
    hot = joins.hot_hashes
    monkeypatch.setattr(joins, "hot_hashes", lambda df, on, min_rows: hot(df, on, 200))
    monkeypatch.setattr(quantiles.exact_quantiles, "__defaults__", (None, 20))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_skewed(spark, skewed, small_limits, name):
    assert oracle.compare(spark, oracle.connect(skewed), QUERIES[name], SQL[name], skewed) == []


def test_hot_rows_are_joined_apart(spark, skewed, small_limits, capsys):
    QUERIES["flagged_events_by_key_year"](spark, skewed).explain()
    assert "Union" in capsys.readouterr().out
