"""Summaries and comparisons of groups of rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keypanel.functions.rates import rounded, stable_sum
from keypanel.operators.quantiles import BROADCAST_KEYS, exact_quantiles


def _long(df: DataFrame, keep: list[Column], metrics: list[str]) -> DataFrame:
    values = [F.col(m).cast("double").alias(m) for m in metrics]
    return df.select(*keep, *values).unpivot(
        [F.col(c) for c in df.select(*keep).columns], metrics, "metric", "value")


def _statistics(long: DataFrame, keys: list[str], few_keys: bool | None = None) -> DataFrame:
    """Mean, median, count of known values and of rows per key, one row each."""
    value = F.col("value")
    return exact_quantiles(long, keys, "value", {"median": 0.5}, also={
        "mean": F.try_divide(stable_sum(value), F.count(value)),
        "count": F.count(value), "rows": F.count("*")}, few_keys=few_keys)


def summarize(df: DataFrame, group: str, metrics: list[str], digits: int = 2) -> DataFrame:
    """Mean, median and count of several metrics per known group, as ``metric_stat`` columns."""
    long = _long(df.dropna(subset=[group]), [F.col(group)], metrics)
    stats = _statistics(long, [group, "metric"])
    return stats.groupBy(group).agg(*[
        F.max(F.when(F.col("metric") == m, value)).alias(f"{m}_{stat}")
        for m in metrics
        for stat, value in (("mean", rounded(F.col("mean"), digits)),
                            ("median", rounded(F.col("median"), digits)),
                            ("count", F.col("count")))])


def compare_cohorts(df: DataFrame, metrics: list[str], first: Column, second: Column,
                    names: tuple[str, str], digits: int = 2) -> DataFrame:
    """One row per metric: mean and median of two cohorts, and the cohort sizes.

    The cohorts are two conditions, such as "flag is 1" and "flag is 0" or "is
    NULL" and "is not NULL"; rows in neither are left out.  Sizes count rows,
    with or without a value.
    """
    a, b = names
    cohort = F.when(first, F.lit(a)).when(second, F.lit(b))
    members = df.withColumn("_cohort", cohort).filter(F.col("_cohort").isNotNull())
    stats = _statistics(_long(members, [F.col("_cohort")], metrics), ["_cohort", "metric"],
                        few_keys=2 * len(metrics) <= BROADCAST_KEYS)

    def of(name: str, column: Column) -> Column:
        return F.max(F.when(F.col("_cohort") == name, column))

    return stats.groupBy("metric").agg(
        *[of(name, rounded(F.col(stat), digits)).alias(f"{name}_{stat}")
          for name in names for stat in ("mean", "median")],
        *[F.coalesce(of(name, F.col("rows")), F.lit(0)).alias(f"{name}_n") for name in names])


def flag_matrix(df: DataFrame, row_flag: str, column_flag: str) -> DataFrame:
    """Rows per combination of two flags."""
    return df.groupBy(row_flag, column_flag).agg(F.count("*").alias("n"))


def bucket_counts(df: DataFrame, value: Column, buckets: list[tuple[str, Column]],
                  missing: str) -> DataFrame:
    """Rows per bucket; a NULL value has a bucket of its own."""
    case = F.when(value.isNull(), F.lit(missing))
    for name, condition in buckets:
        case = case.when(condition, F.lit(name))
    return df.groupBy(case.alias("bucket")).agg(F.count("*").alias("n"))
