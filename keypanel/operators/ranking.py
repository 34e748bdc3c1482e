"""Top and bottom rows, first row per group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from keypanel.session import checkpointed


def largest(df: DataFrame, value: str, tie: str, n: int) -> DataFrame:
    """The n rows with the largest value; ties go to the smaller ``tie`` column."""
    return df.dropna(subset=[value]).orderBy(F.desc(value), F.asc(tie)).limit(n)


def smallest(df: DataFrame, value: str, tie: str, n: int) -> DataFrame:
    return df.dropna(subset=[value]).orderBy(F.asc(value), F.asc(tie)).limit(n)


def top_bottom(df: DataFrame, label: str, value: str, top: int = 10, bottom: int = 0,
               highlight: list[str] | None = None) -> DataFrame:
    """Top n and bottom m rows without duplicates, ascending, with side and highlight."""
    data = df.select(label, value).dropna()
    picked = largest(data, value, label, top).withColumn("_low", F.lit(0))
    if bottom > 0:
        low = smallest(data, value, label, bottom).withColumn("_low", F.lit(1))
        picked = picked.unionByName(low)
    marked = F.col(label).cast("string").isin(*(highlight or [])).cast("int")
    return (picked.groupBy(label, value).agg(F.max("_low").alias("_low"))
            .select(label, value,
                    F.when(F.col("_low") == 1, "bottom").otherwise("top").alias("side"),
                    marked.alias("highlight"))
            .orderBy(F.asc(value), F.asc(label)))


def first_per_group(df: DataFrame, subset: list[str], order_by: list[Column | str]) -> DataFrame:
    """One row per group, the first in the given order.

    Spark keeps one row per group and map task before the shuffle, so a group of
    many copies does not pile up in one task.
    """
    order = W.partitionBy(*subset).orderBy(*order_by)
    return df.withColumn("_rank", F.row_number().over(order)).filter("_rank = 1").drop("_rank")


def with_position(df: DataFrame, column: str, name: str) -> DataFrame:
    """Zero-based position of each row in the order of a column, without one task sorting all.

    Rows are range-partitioned and written with their partition number; the
    position is the rank inside the partition plus the rows of those before it.
    """
    ranged = checkpointed(df.repartitionByRange(column).withColumn("_part", F.spark_partition_id()))
    sizes = ranged.groupBy("_part").agg(F.count("*").alias("_size"))
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.withColumn("_before", F.coalesce(F.sum("_size").over(before), F.lit(0))).drop("_size")
    inside = F.row_number().over(W.partitionBy("_part").orderBy(column)) - 1
    return (ranged.withColumn("_inside", inside).join(F.broadcast(offsets), "_part")
            .withColumn(name, F.col("_before") + F.col("_inside")).drop("_part", "_inside", "_before"))
