"""Tables that are stored by the id they are joined on.

Tables with the same buckets of one id join, and are grouped by it, without an
exchange of either: the shuffle is paid once, when a table is written.
"""

from __future__ import annotations

import contextlib
import io
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keypanel.operators.joins import HOT_ROWS, hot_hashes

BUCKET_BYTES = 256 * 1024 * 1024
# Extra tasks that write the rows of hot ids, each its own file of their buckets.
SPREAD = 64


def buckets_for(largest_bytes: int) -> int:
    """Buckets for tables that are stored alike, by the size of the largest: a power of two."""
    return 1 << max(0, -(-largest_bytes // BUCKET_BYTES) - 1).bit_length()


def save_bucketed(df: DataFrame, name: str, on: str | list[str], buckets: int, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Store a table in buckets of an id, sorted in each file, and read it from there.

    A bucket is written by one task as one file.  Rows of ids that hold a large share
    of the table are dealt to further tasks, which add files to the same buckets, so
    no task writes a hot id alone.  The table must not exist.  Rows without an id share
    a bucket like rows of any id.
    """
    on = [on] if isinstance(on, str) else list(on)
    hot = hot_hashes(df, on, hot_rows) if hot_rows is not None else []
    task = F.pmod(F.hash(*on), F.lit(buckets))
    if hot:
        plain = [F.col(f"`{f.name}`") for f in df.schema.fields if "map<" not in f.dataType.simpleString() and "variant" not in f.dataType.simpleString()]
        task = F.when(F.xxhash64(*on).isin(hot), buckets + F.pmod(F.xxhash64(*plain), F.lit(SPREAD)).cast("int")).otherwise(task)
    dealt = df.repartitionById(buckets + (SPREAD if hot else 0), task)
    dealt.write.bucketBy(buckets, *on).sortBy(*on).saveAsTable(name)
    return df.sparkSession.table(name)


def plan_text(df: DataFrame) -> str:
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain()
    return text.getvalue()


def exchanges_on(df: DataFrame, *columns: str) -> list[str]:
    """The exchanges of a plan that deal rows by one of the columns."""
    found = re.findall(r"Exchange (hashpartitioning\([^\n]*|rangepartitioning\([^\n]*)", plan_text(df))
    return [e for e in found if any(re.search(rf"\b{re.escape(c)}#\d", e) for c in columns)]


def expect_stored_by(df: DataFrame, *columns: str) -> DataFrame:
    """The table itself, if its plan deals no rows by these columns; else an error."""
    found = exchanges_on(df, *columns)
    if found:
        raise ValueError(f"the plan still exchanges rows by {', '.join(columns)}: {found[0]}")
    return df
