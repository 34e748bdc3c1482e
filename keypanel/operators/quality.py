"""Quality checks as DataFrames, and expectations that raise."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keypanel.functions.rates import fixed_round
from keypanel.operators.columns import missing_columns

MAX_NULL_SHARE = 0.10


def null_audit(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Rows, nulls and null share per column, from one aggregate over the table."""
    names = columns or df.columns
    return null_shares(df.agg(F.count("*").alias("rows"), *[
        F.count_if(F.col(f"`{c}`").isNull()).alias(f"n{i}") for i, c in enumerate(names)]), names)


def null_shares(counts: DataFrame, names: list[str]) -> DataFrame:
    """One row per column from one row with ``rows`` and the nulls ``n0``, ``n1``, ..."""
    entries = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("nulls"))
                        for i, c in enumerate(names)])
    long = counts.select("rows", F.explode(entries).alias("e")).select("e.column", "rows", "e.nulls")
    raw = F.coalesce(F.try_divide(F.col("nulls").cast("double"), F.col("rows")), F.lit(0.0))
    return long.withColumn("null_share", fixed_round(raw, 4)).withColumn("raw_share", raw)


def _comparable(df: DataFrame) -> list[Column]:
    """The columns of a row, long texts as their SHA-256 digest.

    A digest has 64 characters and so never equals a text that was kept.
    """
    return [F.when(F.length(F.col(f"`{f.name}`")) >= 64, F.sha2(F.col(f"`{f.name}`"), 256))
            .otherwise(F.col(f"`{f.name}`")).alias(f.name)
            if isinstance(f.dataType, T.StringType) else F.col(f"`{f.name}`")
            for f in df.schema.fields]


def _distinct_rows(df: DataFrame) -> DataFrame:
    """Distinct rows with their number of copies; only digests of long texts are shuffled."""
    rows = df.select(*_comparable(df))
    return rows.groupBy(*[F.col(f"`{c}`") for c in rows.columns]).agg(F.count("*").alias("_copies"))


def duplicate_count(df: DataFrame) -> DataFrame:
    """Rows minus distinct rows; equal NULLs make equal rows."""
    return _distinct_rows(df).agg(
        F.coalesce(F.sum("_copies"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).alias("duplicates"))


def quality(df: DataFrame, required: list[str] | None = None,
            max_null_share: float = MAX_NULL_SHARE) -> DataFrame:
    """Report as rows ``(check, column, value, status)``.

    Checks: row count, duplicate rows, null share per column (warns above the
    threshold, not at it) and required columns that are absent.  Rows, duplicates
    and nulls are all counted on the distinct rows, so the table is read once.
    """
    copies = F.col("_copies")
    counts = _distinct_rows(df).agg(
        F.coalesce(F.sum(copies), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(copies - 1), F.lit(0)).alias("duplicates"),
        *[F.coalesce(F.sum(F.when(F.col(f"`{c}`").isNull(), copies)), F.lit(0)).alias(f"n{i}")
          for i, c in enumerate(df.columns)])
    raw = [F.coalesce(F.try_divide(F.col(f"n{i}").cast("double"), F.col("rows")), F.lit(0.0))
           for i in range(len(df.columns))]

    def line(check: str, column: str | None, value: Column, status: Column) -> Column:
        return F.struct(F.lit(check).alias("check"), F.lit(column).cast("string").alias("column"),
                        value.cast("double").alias("value"), status.alias("status"))

    ok, warn = F.lit("ok"), F.lit("warn")
    lines = [line("row_count", None, F.col("rows"), ok), line("duplicate_count", None, F.col("duplicates"), ok)]
    lines += [line("null_share", c, fixed_round(r, 4), F.when(r > max_null_share, warn).otherwise(ok))
              for c, r in zip(df.columns, raw)]
    lines += [line("missing_column", c, F.lit(None), warn) for c in missing_columns(df, required or [])]
    return counts.select(F.explode(F.array(*lines)).alias("e")).select("e.*")


def audit_tables(tables: dict[str, DataFrame]) -> DataFrame:
    """Row counts and nulls of every column of several tables, in one result."""
    audits = [null_audit(df).select(F.lit(name).alias("table"), "column", "rows", "nulls", "null_share")
              for name, df in tables.items()]
    return reduce(DataFrame.unionByName, audits)


def sparse_columns(df: DataFrame, max_null_share: float | None = None,
                   max_nulls: int | None = None) -> DataFrame:
    """Columns with more nulls than a share or a number of rows allows."""
    audit = null_audit(df)
    over = F.lit(False)
    if max_null_share is not None:
        over = over | (F.col("raw_share") > max_null_share)
    if max_nulls is not None:
        over = over | (F.col("nulls") > max_nulls)
    return audit.filter(over).drop("raw_share")


def repeated_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def absent_keys(expected: DataFrame, present: DataFrame, on: str | list[str]) -> DataFrame:
    """Expected keys that are not present."""
    return expected.select(on).distinct().join(present.select(on).distinct(), on, "left_anti")


def unsupported_values(df: DataFrame, trigger: Column, needs: Column) -> DataFrame:
    """Rows where one column is filled although the column it depends on is not."""
    return df.filter(trigger.isNotNull() & needs.isNull())


def expect_rows(df: DataFrame, n: int) -> DataFrame:
    """Raise unless the table has exactly n rows."""
    found = df.count()
    if found != n:
        raise ValueError(f"expected {n} rows, found {found}")
    return df


def expect_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """Raise if a key occurs more than once, naming one that does."""
    repeated = repeated_keys(df, keys).first()
    if repeated is not None:
        raise ValueError(f"key is not unique: {repeated.asDict()}")
    return df


def expect_values(df: DataFrame, totals: dict[str, tuple[Column, float]]) -> DataFrame:
    """Raise unless each aggregate has its expected value."""
    found = df.agg(*[column.alias(name) for name, (column, _) in totals.items()]).first().asDict()
    wrong = {n: (found[n], want) for n, (_, want) in totals.items() if found[n] != want}
    if wrong:
        raise ValueError(f"unexpected totals (found, expected): {wrong}")
    return df
