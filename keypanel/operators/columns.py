"""Column names and column sets.  Only metadata is touched; no job is run."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A byte-order mark, read correctly or as Latin-1.
BYTE_ORDER_MARKS = ("\ufeff", "ï»¿")


def _renamed(df: DataFrame, names: list[str]) -> DataFrame:
    if len(set(names)) != len(names):
        clash = sorted({n for n in names if names.count(n) > 1})
        raise ValueError(f"column names collide after renaming: {clash}")
    return df.toDF(*names)


def tidy_name(name: str) -> str:
    """Strip, lower, blanks and hyphens to underscores."""
    return re.sub(r"[ -]", "_", name.strip().lower())


def safe_name(name: str) -> str:
    """Every run of characters other than a-z and 0-9 becomes one underscore."""
    return "_".join(re.findall(r"[a-z0-9]+", name.lower()))


def repaired_name(name: str) -> str:
    """Strip, lower and drop a byte-order mark from a header cell."""
    name = name.strip().lower()
    for mark in BYTE_ORDER_MARKS:
        name = name.removeprefix(mark)
    return name


def repaired_header(names: list[str], key: str) -> list[str]:
    """Repair all header cells; if ``key`` is still missing, take the first that ends with it."""
    names = [repaired_name(n) for n in names]
    if key not in names:
        candidates = [n for n in names if n.endswith(key)]
        if candidates:
            names[names.index(candidates[0])] = key
    return names


def tidy_names(df: DataFrame) -> DataFrame:
    return _renamed(df, [tidy_name(c) for c in df.columns])


def safe_names(df: DataFrame) -> DataFrame:
    return _renamed(df, [safe_name(c) for c in df.columns])


def lower_names(df: DataFrame) -> DataFrame:
    return _renamed(df, [c.lower() for c in df.columns])


def repaired_names(df: DataFrame, key: str) -> DataFrame:
    return _renamed(df, repaired_header(df.columns, key))


def with_prefix(df: DataFrame, prefix: str) -> list[str]:
    """Names of the columns that start with a prefix."""
    return [c for c in df.columns if c.startswith(prefix)]


def replace_prefix(df: DataFrame, old: str, new: str) -> DataFrame:
    return df.withColumnsRenamed({c: new + c[len(old):] for c in with_prefix(df, old)})


def ids_first(df: DataFrame, ids: list[str]) -> DataFrame:
    """Id columns first, the others in alphabetical order."""
    return df.select(*ids, *sorted(c for c in df.columns if c not in ids))


def flatten_structs(df: DataFrame) -> DataFrame:
    """Nested objects to dotted columns, at every depth."""
    flat = []

    def walk(fields, path):
        for field in fields:
            full = path + [field.name]
            if field.dataType.typeName() == "struct":
                walk(field.dataType.fields, full)
            else:
                source = ".".join(f"`{p}`" for p in full)
                flat.append(F.col(source).alias(".".join(full)))

    walk(df.schema.fields, [])
    return df.select(*flat)


def missing_columns(df: DataFrame, required: list[str]) -> list[str]:
    return [c for c in required if c not in df.columns]
