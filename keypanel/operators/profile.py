"""Table profiles: frequent values and numeric summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from keypanel.functions.rates import rounded, stable_sum
from keypanel.operators.quantiles import BROADCAST_KEYS, exact_quantiles

QUARTILES = {"p25": 0.25, "p50": 0.5, "p75": 0.75}


def value_counts(df: DataFrame, top: int = 10) -> DataFrame:
    """The most frequent values of every column, NULL counted as a value.

    Values are counted with map-side combine; of the counts only ``top`` rows
    per column and task reach the final ranking.
    """
    texts = df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])
    counts = (texts.unpivot([], [F.col(f"`{c}`") for c in df.columns], "column", "value")
              .groupBy("column", "value").agg(F.count("*").alias("n")))
    order = W.partitionBy("column").orderBy(F.desc("n"), F.asc_nulls_last("value"))
    return counts.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def _by_column(df: DataFrame, names: list[str]) -> DataFrame:
    return (df.select(*[F.col(f"`{c}`").cast("double").alias(c) for c in names])
            .unpivot([], [F.col(f"`{c}`") for c in names], "column", "value"))


def table_stats(df: DataFrame, columns: list[str], digits: int = 2) -> DataFrame:
    """Sum, min, max, mean and median of whole columns, one row per column."""
    value, total = F.col("value"), stable_sum(F.col("value"))
    stats = exact_quantiles(_by_column(df, columns), ["column"], "value", {"median": 0.5}, also={
        "sum": total, "min": F.min(value), "max": F.max(value),
        "mean": F.try_divide(total, F.count(value))}, few_keys=len(columns) <= BROADCAST_KEYS)
    return stats.select("column", *[rounded(F.col(s), digits).alias(s)
                                    for s in ("sum", "min", "max", "mean", "median")])


def numeric_summary(df: DataFrame, columns: list[str] | None = None, digits: int = 2) -> DataFrame:
    """Count, mean, standard deviation, min, exact quartiles and max per numeric column."""
    names = columns or numeric_columns(df)
    value = F.col("value")
    stats = exact_quantiles(_by_column(df, names), ["column"], "value", QUARTILES, also={
        "count": F.count(value), "mean": F.avg(value), "std": F.stddev_samp(value),
        "min": F.min(value), "max": F.max(value)}, few_keys=len(names) <= BROADCAST_KEYS)
    shown = ["mean", "std", "min", *QUARTILES, "max"]
    return stats.select("column", "count", *[rounded(F.col(s), digits).alias(s) for s in shown])
