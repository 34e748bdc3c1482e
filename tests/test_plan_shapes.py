"""What the physical plans look like, and queries under the settings of a large job."""

import contextlib
import io
from collections import Counter

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import workload
import oracle
from keypanel.sources import html
from workload.text import part_pages

SF = "/root/testdata/sf0.001"
QUERIES, SQL = workload.QUERIES, workload.SQL
# The only queries that run Python on executors.
PYTHON = {"html_records", "html_table_by_index", "html_largest_table"}


def plan(spark, name, mode="simple"):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        QUERIES[name](spark, SF).explain(mode=mode)
    return text.getvalue()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - PYTHON))
def test_no_python_and_no_cartesian_product(spark, name):
    text = plan(spark, name)
    for operator in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "MapInArrow", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert operator not in text


def test_python_only_for_html(spark):
    for name in PYTHON:
        assert plan(spark, name).count("MapInArrow") == 1


@pytest.fixture
def many_parts(tmp_path):
    """4000 parts in one row group of one file, keys repeated and missing."""
    rows = [(i % 3900 or None, f"name {i}", f"brand {i % 7}", "PROMO" if i % 5 else None, i % 50, 1.0) for i in range(4000)]
    names = ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int32(), pa.float64()]
    columns = {n: pa.array(c, k) for n, c, k in zip(names, zip(*rows), kinds)}
    pq.write_table(pa.table(columns), f"{tmp_path}/part.parquet", row_group_size=len(rows))
    return str(tmp_path)


def test_pages_of_one_row_group_are_read_by_all_tasks_largest(spark, many_parts):
    pages = part_pages(spark, many_parts)
    read = html.page_tables(pages, largest=True).groupBy(F.spark_partition_id()).agg(F.countDistinct("page_id").alias("n"))
    shares = sorted(r["n"] for r in read.collect())
    assert len(shares) == int(spark.conf.get("spark.sql.shuffle.partitions")) and shares[-1] <= 2 * shares[0]
    assert plan(spark, "html_largest_table").count("Exchange RoundRobinPartitioning") == 1


def test_pages_of_one_row_group_are_read_by_all_tasks_by_index(spark, many_parts):
    found = QUERIES["html_table_by_index"](spark, many_parts).withColumn("task", F.spark_partition_id())
    shares = sorted(r["count"] for r in found.groupBy("task").count().collect())
    assert len(shares) == int(spark.conf.get("spark.sql.shuffle.partitions")) and shares[-1] <= 2 * shares[0]
    # A part without a type has no page.
    expected = [(i % 3900 or None, f"name {i}", str(i % 50)) for i in range(4000) if i % 5]
    expected += [(i % 3900 or None, f"brand {i % 7}", "PROMO & more") for i in range(4000) if i % 5]
    assert Counter(map(tuple, found.drop("task").collect())) == Counter(expected)


# Statistics of whole columns: sketches and counts are shuffled, never the rows.
COLUMN_STATS = ["tiny_measure_stats", "fine_measure_stats", "numeric_profile", "whole_table_stats"]


@pytest.mark.parametrize("name", COLUMN_STATS)
def test_rows_of_a_column_stay_where_they_are_read(spark, name):
    settings = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    try:
        for setting in settings:
            spark.conf.set(setting, "-1")
        text = plan(spark, name)
    finally:
        for setting in settings:
            spark.conf.unset(setting)
    assert text.count("BroadcastHashJoin") == 1 and "SortMergeJoin" not in text
    assert text.count("Exchange hashpartitioning") == 3 and text.count("partial_kll") == 1


def test_counts_are_combined_before_the_shuffle(spark):
    text = plan(spark, "test_rates_by_key")
    assert text.count("Exchange hashpartitioning") == 1
    assert text.count("partial_") > 10
    assert "SortMergeJoin" not in text


def test_flag_join_shuffles_narrow_rows(spark):
    text = plan(spark, "flagged_events_by_key_year", "formatted")
    assert "ReadSchema: struct<l_orderkey:bigint,l_returnflag:string>" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_totalprice:double,o_orderdate:timestamp_ntz>" in text


def test_filters_reach_the_scan(spark):
    text = plan(spark, "slice_filter", "formatted")
    assert "EqualTo(o_orderstatus,F)" in text and "GreaterThanOrEqual(o_orderdate" in text
    assert "Exchange" not in text


def test_first_row_is_chosen_before_the_shuffle(spark):
    text = plan(spark, "clean_keep_first")
    assert text.count("WindowGroupLimit") == 2
    assert plan(spark, "frequent_values").count("WindowGroupLimit") == 2


def test_label_lines_do_not_shuffle(spark):
    for name in ("label_values_by_document", "page_label_table", "label_value_lines", "html_headings"):
        assert "Exchange" not in plan(spark, name)


def test_lookups_cost_one_exchange(spark):
    assert plan(spark, "test_rates_by_key").count("Exchange hashpartitioning") == 1


def test_scans_and_exchanges_are_few(spark):
    assert plan(spark, "wide_master_table").count("lineitem.parquet") == 1
    assert "lineitem.parquet" not in plan(spark, "comparable_trend")
    assert plan(spark, "hand_checked_overrides").count("customer.parquet") == 1


@pytest.mark.parametrize("name", ["flagged_events_by_key_year", "prior_history_by_key", "wide_master_table", "cohorts_by_null",
                                  "numeric_profile", "totals_across_layouts", "quality_report",
                                  "test_rates_by_key", "rates_by_key", "top_and_bottom", "yearly_columns_by_key", "prior_share"])
def test_results_without_broadcast_joins(spark, name):
    """Above the broadcast thresholds the same queries join by shuffle, with the same result."""
    settings = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    try:
        for setting in settings:
            spark.conf.set(setting, "-1")
        assert oracle.compare(spark, oracle.connect(SF), QUERIES[name], SQL[name], SF) == []
    finally:
        for setting in settings:
            spark.conf.unset(setting)
