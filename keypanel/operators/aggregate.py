"""Keyed aggregation.

All measures of one table are computed in a single hash aggregate with
map-side combine: one scan, one shuffle, and a key that holds a third of the
rows still arrives at its reducer as one row per map task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keypanel.functions.rates import not_in_keeping_null


def count_where(condition: Column) -> Column:
    """Rows for which a condition holds; 0 when there are none."""
    return F.count_if(condition)


def sum_where(value: Column, condition: Column) -> Column:
    """Sum over the rows for which a condition holds; 0 when there are none."""
    return F.coalesce(F.sum(F.when(condition, value)), F.lit(0))


def code_counts(code: Column, named: dict[str, object], other: str,
                where: Column | None = None) -> dict[str, Column]:
    """One count per listed code and one for every other known code."""
    inside = F.lit(True) if where is None else where
    counts = {name: count_where(inside & (code == value)) for name, value in named.items()}
    rest = inside & code.isNotNull() & ~code.isin(*named.values())
    return {**counts, other: count_where(rest)}


def known_codes(code: Column, unknown: list) -> Column:
    """Rows whose code is not one of the "unknown" codes; a NULL code counts as known."""
    return not_in_keeping_null(code, unknown)


def profile_by_key(df: DataFrame, keys: list[str], measures: dict[str, Column],
                   drop_null_keys: bool = True) -> DataFrame:
    """Group by the keys and compute all measures in one pass."""
    source = df.dropna(subset=keys) if drop_null_keys else df
    return source.groupBy(*keys).agg(*[m.alias(name) for name, m in measures.items()])


def profile_through(df: DataFrame, via: str, lookup: DataFrame, keys: list[str],
                    measures: dict[str, Column], extra_keys: tuple[str, ...] = ()) -> DataFrame:
    """Aggregate events to a key that is found through a lookup table.

    One plan for a lookup of any size and for any measure: Spark broadcasts a lookup
    whose measured size is below its threshold, else both sides are shuffled on
    ``via`` and a partition that a hot id makes large is split; the aggregate
    combines on the map side.  ``lookup`` holds one row per ``via`` id and the
    columns ``keys``; events without an entry drop out.
    """
    return profile_by_key(df.join(lookup.select(via, *keys), via), [*keys, *extra_keys], measures)


def median_of_counts(value: str, count: str) -> Column:
    """Exact median of values that were counted first.

    For measures from a short list of values (a speed, a size): the state is one
    entry per distinct value.  Use ``quantiles.exact_quantiles`` otherwise.
    """
    return F.percentile(F.col(value), F.lit(0.5), F.col(count))


def mean_with_error(df: DataFrame, group: str, value: str) -> DataFrame:
    """Mean, sample standard deviation, count and standard error per group, largest mean first."""
    value_column = F.col(value)
    return df.groupBy(group).agg(
        F.avg(value_column).alias("mean"),
        F.stddev_samp(value_column).alias("std"),
        F.count(value_column).alias("n"),
    ).withColumn("se", F.try_divide(F.col("std"), F.sqrt(F.col("n")))).orderBy(F.desc("mean"))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct known values in order."""
    return df.select(column).dropna().distinct().orderBy(column)
