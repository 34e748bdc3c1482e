"""Exact quantiles against numpy, with and without narrowing, and with hot keys."""

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from keypanel.operators import profile, quantiles
from keypanel.operators.quantiles import exact_quantiles

PROBS = {"q25": 0.25, "q50": 0.5, "q75": 0.75, "q90": 0.9}


def check(spark, pairs):
    df = spark.createDataFrame(pairs, "k string, v double").repartition(4)
    found = {r["k"]: r for r in exact_quantiles(df, ["k"], "v", PROBS, also={"rows": F.count("*")}).collect()}
    groups = {}
    for k, v in pairs:
        groups.setdefault(k, []).append(v)
    assert set(found) == set(groups)
    for k, values in groups.items():
        known = [v for v in values if v is not None and not np.isnan(v)]
        assert found[k]["rows"] == len(values)
        for name, q in PROBS.items():
            if known:
                assert found[k][name] == pytest.approx(np.quantile(known, q), rel=1e-12, abs=1e-300)
            else:
                assert found[k][name] is None


VALUES = st.one_of(st.none(), st.floats(-1e9, 1e9, allow_subnormal=False), st.integers(-3, 3).map(float), st.just(float("nan")))


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), VALUES), min_size=1, max_size=50))
def test_small_groups(spark, pairs):
    check(spark, pairs)


def test_hot_key_and_narrow_spread(spark):
    """Most rows in one key, and values that differ only far behind the point."""
    rng = np.random.default_rng(5)
    pairs = [("hot", float(1e6 + x)) for x in rng.random(6000) * 1e-3]
    pairs += [("wide", float(x)) for x in np.exp(rng.normal(0, 20, 1500))]
    pairs += [("copies", 7.0)] * 3000 + [("one", -2.5), ("none", None)]
    check(spark, pairs)


def test_without_keys(spark):
    df = spark.range(1, 1002).select(F.col("id").cast("double").alias("v"))
    assert exact_quantiles(df, [], "v", {"m": 0.5}).collect() == [(501.0,)]


def test_infinities(spark):
    inf = float("inf")
    df = spark.createDataFrame([("a", 1.0), ("a", inf), ("a", inf), ("b", -inf), ("b", 2.0)], "k string, v double")
    found = {r["k"]: r["m"] for r in exact_quantiles(df, ["k"], "v", {"m": 0.5}).collect()}
    assert found == {"a": inf, "b": -inf}


def test_brackets_of_a_coarse_sketch(spark):
    """Groups far larger than the sketch, with and without heavy values; every kind of spread."""
    df = spark.range(200_000).select(
        (F.col("id") % 3).alias("k"), F.expr("CASE id % 3 WHEN 0 THEN hash(id) / 7.0 WHEN 1 THEN floor(log2(1 + abs(hash(id)) % 1000)) "
                                             "ELSE exp(hash(id) / 1e8) END").alias("v"))
    values = {}
    for r in df.collect():
        values.setdefault(r["k"], []).append(r["v"])
    for k in (200, 4096):
        found = {r["k"]: r for r in exact_quantiles(df, ["k"], "v", PROBS, k=k).collect()}
        for key, own in values.items():
            for name, q in PROBS.items():
                assert found[key][name] == pytest.approx(np.quantile(own, q), rel=1e-12)


def test_a_missed_bracket_fails(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "MARGIN", -20)  # brackets that end before they begin
    monkeypatch.setattr(quantiles, "ROUNDING", 0)
    df = spark.range(50_000).select(F.col("id").cast("double").alias("v"))
    with pytest.raises(Exception, match="not in its bracket"):
        exact_quantiles(df, [], "v", {"m": 0.5}).collect()


@pytest.mark.parametrize("threshold", ["10MB", "-1"])
def test_two_scans_and_four_exchanges(spark, tmp_path, threshold):
    spark.range(100_000).select((F.col("id") % 5).alias("k"), F.col("id").cast("double").alias("v")).write.parquet(f"{tmp_path}/t")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", threshold)
    try:
        df = exact_quantiles(spark.read.parquet(f"{tmp_path}/t"), ["k"], "v", PROBS, also={"rows": F.count("*"), "mean": F.avg("value")})
        assert {r["q50"] - r["k"] for r in df.collect()} == {49_997.5}
        final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    assert final.count("FileScan parquet") == 2 and "SortAggregate" not in final
    assert final.count("Exchange ") <= 4


@pytest.fixture
def without_broadcast(spark):
    """Brackets are beyond the thresholds, as those merged from many sketches are."""
    settings = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    for setting in settings:
        spark.conf.set(setting, "-1")
    yield
    for setting in settings:
        spark.conf.unset(setting)


def plan_below_join(df):
    """The join, and what stands between it and the scan of the raw rows, after the query has run."""
    df.collect()
    lines = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0].splitlines()
    join = next(i for i, line in enumerate(lines) if "Join" in line)
    scan = next(i for i, line in enumerate(lines) if i > join and "FileScan" in line)
    return lines[join], "\n".join(lines[join + 1:scan])


@pytest.fixture
def measures(spark, tmp_path):
    spark.range(20_000).select((F.col("id") % 50).cast("double").alias("quantity"), F.when(F.col("id") % 9 > 0, F.col("id") / 8).alias("price"),
                               F.lit(None).cast("double").alias("none")).write.parquet(f"{tmp_path}/t")
    return spark.read.parquet(f"{tmp_path}/t")


def test_rows_of_a_column_are_not_shuffled_table_stats(spark, measures, without_broadcast):
    """No task reads all rows of a column, whatever size Spark takes the brackets for."""
    found = profile.table_stats(measures, ["quantity", "price", "none"])
    join, between = plan_below_join(found)
    assert "BroadcastHashJoin" in join and "Exchange" not in between
    known = [i / 8 for i in range(20_000) if i % 9]
    assert {r["column"]: r["median"] for r in found.collect()} == {
        "quantity": 24.5, "price": pytest.approx(np.median(known), abs=0.005), "none": None}


def test_counts_of_hot_keys_among_many(spark, tmp_path, without_broadcast, monkeypatch):
    """Beyond the bound rows are shuffled; the partition of a hot key is split and the result is the same."""
    rows = spark.range(60_000).select(F.expr("IF(id % 4 > 0, 7, nullif(id % 400, 0))").alias("k"), F.expr("hash(id) / 7.0").alias("v"))
    rows.write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t").repartition(6)
    few = exact_quantiles(df, ["k"], "v", PROBS, k=200).collect()
    monkeypatch.setattr(quantiles, "BROADCAST_KEYS", 50)
    settings = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k"}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        many = exact_quantiles(df, ["k"], "v", PROBS, k=200)
        assert sorted(map(str, many.collect())) == sorted(map(str, few)) and len(few) == 101
        join, _ = plan_below_join(many)
    finally:
        for name in settings:
            spark.conf.unset(name)
    assert "SortMergeJoin(skew=true)" in join
