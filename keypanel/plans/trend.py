"""Trends over comparable years only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keypanel.functions.rates import share


def trend(series: DataFrame, keys: DataFrame, key: str, label: list[str], first: int, last: int,
          part: str, whole: str, method: str | None = None, method_column: str = "method",
          digits: int = 1) -> DataFrame:
    """Share per key and year inside a range of years.

    With ``method`` only rows measured that way are used.  Without it all rows of
    the range must share one method: two methods are not comparable and raise
    when the result is computed.
    """
    rows = series.filter(F.col("year").between(first, last))
    if method is not None:
        rows = rows.filter(F.col(method_column) == method)
    elif method_column in series.columns:
        rows = _one_method(rows, method_column)
    return (rows.join(keys.select(key, *label), key)
            .select(key, *label, "year", part, whole,
                    share(F.col(part), F.col(whole), digits).alias("pct"))
            .orderBy(*label, "year"))


def _one_method(rows: DataFrame, column: str) -> DataFrame:
    """Raise, when the result is computed, if the rows were measured by more than one method."""
    methods = rows.agg(F.sort_array(F.collect_set(F.col(column).cast("string")))).scalar()
    mixed = F.raise_error(F.concat(F.lit("the years mix methods "), F.array_join(methods, ", "), F.lit("; name one")))
    return rows.where(F.when(F.size(methods) > 1, mixed.cast("boolean")).otherwise(F.lit(True)))
