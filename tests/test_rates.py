from fractions import Fraction

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from keypanel.functions import rates

PAIRS = st.lists(st.tuples(st.one_of(st.none(), st.integers(-50, 10_000)), st.one_of(st.none(), st.integers(0, 50))),
                 min_size=1, max_size=40)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(PAIRS)
def test_rate_is_null_only_without_a_denominator(spark, pairs):
    df = spark.createDataFrame(pairs, "n int, d int")
    for n, d, r in df.select("n", "d", rates.rate(F.col("n"), F.col("d"), 100.0, 2)).collect():
        assert (r is None) == (n is None or d is None or d == 0)
        if r is not None:
            assert abs(r - n * 100.0 / d) <= 0.0051


def test_published_rates(spark, rows):
    """Published numbers: deaths, modelled deaths, population and both rates per 100,000."""
    published = [(962, 277, 5157699, 18.65, 5.37), (70, 13, 740133, 9.46, 1.76), (1229, 419, 7582384, 16.21, 5.53),
                 (603, 154, 3088354, 19.52, 4.99)]
    df = spark.createDataFrame(published, "deaths int, modelled int, pop int, a double, b double")
    for r in df.select("*", rates.rate(F.col("deaths"), F.col("pop"), 100_000.0).alias("x"),
                       rates.rate(F.col("modelled"), F.col("pop"), 100_000.0).alias("y")).collect():
        assert (r["x"], r["y"]) == (r["a"], r["b"])


def test_flags_and_sums(spark, rows):
    df = spark.createDataFrame([(1, 5, None), (2, None, 3), (3, 98, 20)], "i int, a int, b int")
    found = rows(df.select("i", rates.flag(F.col("a") > 4), rates.sufficient(F.col("b"), 15),
                           rates.row_sum(F.col("a"), F.col("b")), rates.share(F.col("a"), F.col("b"), 1)), "i")
    assert found == [(1, 1, 0, 5, None), (2, 0, 0, 3, None), (3, 1, 1, 118, 490.0)]


def test_not_in_keeps_null(spark, rows):
    df = spark.createDataFrame([(1, 0), (2, 99), (3, None)], "i int, code int")
    assert [r[0] for r in rows(df.filter(rates.not_in_keeping_null(F.col("code"), [98, 99])), "i")] == [1, 3]


def test_rounding_modes(spark, rows):
    df = spark.createDataFrame([(0.125, 1, "x")], "v double, n int, t string")
    assert rows(rates.round_floats(df, 2)) == [(0.13, 1, "x")]
    assert rows(rates.round_floats(df, 2, mode="even")) == [(0.12, 1, "x")]


SUMS = [[4e-13] * 1000, [4e-14] * 1000, [1e-25] * 10, [5e-324] * 3, [1e17] * 7, [1e300] * 2, [float("inf"), 1.0], [-1e-13, 1e-13, 2.5e-13],
        [0.1] * 10, [-0.5, 0.25], [2.0 ** 59, -1.0], [0.0, 0.0], [10.0 ** e * (1 + e / 97) * (-1) ** e for e in range(-18, 18)], [1.5, None], [None]]


def test_sums_of_any_magnitude(spark):
    df = spark.createDataFrame([(i, v) for i, values in enumerate(SUMS) for v in values], "i int, v double").repartition(5)
    found = {r["i"]: r["s"] for r in df.groupBy("i").agg(rates.stable_sum(F.col("v")).alias("s")).collect()}
    for i, values in enumerate(SUMS):
        known = [v for v in values if v is not None]
        exact = known and (known[0] if known[0] == float("inf") else float(sum(map(Fraction, known))))
        assert found[i] == (pytest.approx(exact, rel=1e-14, abs=0) if known else None)


def test_sums_do_not_depend_on_the_order(spark):
    df = spark.range(5000).select((F.hash("id") * F.pow(F.lit(10.0), (F.col("id") % 24) - 15)).alias("v"))
    assert len({df.orderBy(F.hash("v", F.lit(i))).repartition(i + 1).agg(rates.stable_sum(F.col("v"))).first()[0] for i in range(3)}) == 1


def test_ratios_that_no_decimal_holds(spark, rows):
    df = spark.createDataFrame([(5e12,), (0.12345,), (1e36,), (float("nan"),), (None,)], "v double")
    assert str(rows(df.select(rates.fixed_round(F.col("v"), 4)))) == str([(5e12,), (0.1235,), (1e36,), (float("nan"),), (None,)])
