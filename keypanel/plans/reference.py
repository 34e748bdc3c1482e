"""Key reference tables: codes, names, yearly measures, the key master table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keypanel.functions.text import number, pad_key, whole_number
from keypanel.operators.columns import replace_prefix, safe_names, with_prefix
from keypanel.operators.joins import one_per_key, wide_join
from keypanel.sources.files import inline_table, read_delimited

# Fixed value: codes above this are not keys of the panel.
LAST_KEY = 56


def key_reference(spark: SparkSession, path: str, key: str, coordinates: tuple[str, ...] = ("lat", "lng"),
                  whole: tuple[str, ...] = ()) -> DataFrame:
    """Key table from CSV: padded key, coordinates and areas as numbers."""
    raw = read_delimited(spark, path)
    columns = []
    for name in raw.columns:
        column = F.col(f"`{name}`")
        if name == key:
            column = pad_key(column)
        elif name in coordinates:
            column = number(column)
        elif name in whole:
            column = whole_number(column, "bigint")
        columns.append(column.alias(name))
    return raw.select(*columns)


def code_list(raw: DataFrame, names: dict[str, str], key: str, last: int = LAST_KEY) -> DataFrame:
    """Code list with clean names, padded key and only the valid codes."""
    table = safe_names(raw).withColumnsRenamed(names)
    valid = whole_number(F.col(key)) <= last
    return table.filter(valid).select(*[
        pad_key(F.col(c)).alias(c) if c == key else F.col(c) for c in names.values()])


def yearly_columns(raw: DataFrame, level: str, level_code: int, code: str, key: str,
                   old_prefix: str, new_prefix: str, keep: dict[str, str], last: int = LAST_KEY) -> DataFrame:
    """One level of a wide file, its yearly columns renamed by prefix."""
    table = safe_names(raw)
    rows = table.filter((F.col(level) == level_code) & (F.col(code) <= last))
    renamed = replace_prefix(rows, old_prefix, new_prefix)
    return renamed.select(pad_key(F.col(code)).alias(key),
                          *[F.col(old).alias(new) for old, new in keep.items()],
                          *with_prefix(renamed, new_prefix))


def key_master(reference: DataFrame, parts: list[tuple[DataFrame, dict[str, str]]], key: str) -> DataFrame:
    """Reference table plus selected, renamed columns of other tables, ordered by key."""
    chosen = [(df.select(key, *[F.col(old).alias(new) for old, new in names.items()]), key)
              for df, names in parts]
    return wide_join(reference, chosen).orderBy(key)


def structural_controls(spark: SparkSession, key: str, columns: dict[str, dict]) -> DataFrame:
    """Literal tables joined on the keys that all of them have."""
    return inline_table(spark, key, columns)


def with_overrides(df: DataFrame, overrides: DataFrame, key: str, column: str) -> DataFrame:
    """Replace single values by hand-checked ones from a table ``(key, column)`` with one row per key.

    A repeated key raises at run time.  Spark broadcasts the overrides when their measured
    size is small, so ``df`` is not shuffled then.
    """
    known = overrides.select(key, F.col(column).cast(df.schema[column].dataType).alias("_fixed")).dropna()
    joined = df.join(one_per_key(known, [key]), key, "left")
    return joined.select(*[F.coalesce("_fixed", F.col(column)).alias(column) if c == column else F.col(c) for c in df.columns])
