"""The data behind maps, bars and lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keypanel.operators.ranking import with_position

# Fixed value: number of colours a category palette cycles through.
PALETTE_SIZE = 6


def map_values(keys: DataFrame, values: DataFrame, on: str, value: str) -> DataFrame:
    """Every key with its value, and whether the value is missing."""
    return (keys.select(on).join(values.select(on, value), on, "left")
            .withColumn("is_missing", F.col(value).isNull().cast("int")))


def value_domain(values: DataFrame, value: str, low: float | None = None,
                 high: float | None = None) -> DataFrame:
    """Colour range: given limits, else the smallest and largest value."""
    column = F.col(value).cast("double")
    return values.agg(F.coalesce(F.lit(low).cast("double"), F.min(column)).alias("domain_min"),
                      F.coalesce(F.lit(high).cast("double"), F.max(column)).alias("domain_max"))


def map_categories(df: DataFrame, category: str, palette: int = PALETTE_SIZE) -> DataFrame:
    """Sorted categories with their palette index: the legend of a map."""
    legend = with_position(df.select(category).dropna().distinct(), category, "_position")
    return legend.select(category, (F.col("_position") % palette).cast("int").alias("palette_index"))


def scatter_points(df: DataFrame, x: Column, y: Column, color_by: Column) -> DataFrame:
    return df.select(x.alias("x"), y.alias("y"), color_by.alias("color_by"))


def long_series(df: DataFrame, x: str, series: list[str]) -> DataFrame:
    """One x and several y columns as rows ``(x, series, y)``."""
    values = [F.col(s).cast("double").alias(s) for s in series]
    return df.select(x, *values).unpivot([x], series, "series", "y").withColumnRenamed(x, "x")
