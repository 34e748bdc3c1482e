"""One cleaning pass: filter, cast, trim, de-duplicate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keypanel.functions.text import number, whole_number
from keypanel.operators.ranking import first_per_group

INTEGERS = {"tinyint", "smallint", "int", "integer", "bigint", "long"}
FLOATS = {"float", "double", "real"}


def safe_cast(df: DataFrame, name: str, type_name: str) -> Column:
    """Cast one column, NULL where the value does not fit."""
    column, wanted = F.col(f"`{name}`"), type_name.lower()
    if isinstance(df.schema[name].dataType, T.StringType):
        if wanted in INTEGERS:
            return whole_number(column, wanted)
        if wanted in FLOATS:
            return number(column).try_cast(wanted)
    return column.try_cast(wanted)


def clean(df: DataFrame, casts: dict[str, str] | None = None, strips: list[str] | None = None,
          where: str | None = None, subset: list[str] | None = None,
          order_by: list[Column | str] | None = None) -> DataFrame:
    """Filter on the raw columns, cast or trim, then drop duplicates.

    Without ``subset`` whole rows are compared.  With it the first row in
    ``order_by`` is kept; Spark rows have no order of their own, so it is
    required.
    """
    casts, strips = casts or {}, strips or []
    source = df.filter(where) if where else df
    columns = []
    for name in df.columns:
        column = F.col(f"`{name}`")
        if name in casts:
            column = safe_cast(df, name, casts[name])
        elif name in strips:
            column = F.trim(column)
        columns.append(column.alias(name))
    cleaned = source.select(*columns)
    if subset is None:
        return cleaned.dropDuplicates()
    if not order_by:
        raise ValueError("order_by decides which duplicate is kept; name the columns")
    return first_per_group(cleaned, subset, order_by)
