"""Equi-joins of keyed tables.

Except where a function says otherwise, joins carry no broadcast hint: Spark
broadcasts a side whose (measured) size is below its own threshold and joins by
shuffle above it, so the same plan works for 25 keys and for a billion.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keypanel.functions.text import normalized
from keypanel.operators.bitmaps import MOST_BITS, bit_array, bits_for, may_hold
from keypanel.session import stored

# An id with fewer rows than this is never treated apart; entries of a frequent-items
# sketch; number of groups sketches are merged in.
HOT_ROWS = 100_000
TRACKED_IDS = 4096
MERGE_GROUPS = 1024
# With fewer bits for an id than this a bit array rules out too few events.
LEAST_BITS_PER_ID = 4


def one_per_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """The table, with an error at run time for a key that repeats; no job of its own.

    Rows whose keys are NULL match nothing in a join and pass unchecked.
    """
    others = [c for c in df.columns if c not in keys]
    known = reduce(lambda a, b: a & b, [F.col(f"`{k}`").isNotNull() for k in keys])
    repeated = F.raise_error(F.concat(F.lit("key is not unique: "), F.to_json(F.struct(*keys))))
    whole = df.groupBy(*keys).agg(F.first(F.struct(*others)).alias("_row") if others else F.lit(1).alias("_row"),
                                  F.count("*").alias("_n"))
    checked = whole.withColumn("_row", F.when((F.col("_n") > 1) & known, repeated).otherwise(F.col("_row")))
    return checked.select(*keys, *[F.col(f"_row.`{c}`").alias(c) for c in others])


def wide_join(spine: DataFrame, parts: list[tuple[DataFrame, str | list[str]]]) -> DataFrame:
    """Left-join many tables onto a spine, one after the other.

    A column that already exists on the left is dropped from the right.  Each
    part must hold one row per key, else the spine would grow: the plan itself
    raises where a key repeats (``quality.repeated_keys`` lists offenders).
    """

    def add(left: DataFrame, part: tuple[DataFrame, str | list[str]]) -> DataFrame:
        right, on = part
        keys = [on] if isinstance(on, str) else list(on)
        fresh = [c for c in right.columns if c in keys or c not in left.columns]
        return left.join(one_per_key(right.select(*fresh), keys), keys, "left")

    return reduce(add, parts, spine)


def outer_merge(left: DataFrame, right: DataFrame, on: str | list[str]) -> DataFrame:
    """Full outer join with one key column."""
    return left.join(right, on, "full")


def hot_hashes(df: DataFrame, on: list[str], min_rows: int = HOT_ROWS,
               tracked: int = TRACKED_IDS) -> list[int]:
    """Hashes of the ids (NULL included) that hold a large share of the rows.

    A frequent-items sketch reads the id columns once.  It surely reports every id
    with more than ``7 / tracked`` of the rows and never more than ``tracked / 3``
    ids; those with fewer than ``min_rows`` rows harm no task and are left out.
    Sketches are merged in two steps so that no task has to take in one sketch
    from every other task.
    """
    rows = df.select(F.xxhash64(*on).alias("h"), (F.spark_partition_id() % MERGE_GROUPS).alias("g"))
    partial = rows.groupBy("g").agg(F.expr(f"approx_top_k_accumulate(h, {tracked})").alias("s"))
    merged = partial.groupBy(F.lit(1)).agg(F.expr(f"approx_top_k_combine(s, {tracked})").alias("s"))
    found = merged.select(F.expr(f"approx_top_k_estimate(s, {tracked // 3})").alias("top")).first()
    return [item["item"] for item in (found["top"] if found else []) if item["count"] >= min_rows]


def exists_flag(events: DataFrame, ids: DataFrame, on: str | list[str], name: str,
                hot_rows: int | None = HOT_ROWS, prefilter: bool = False) -> DataFrame:
    """Add a 0/1 column: does the id of this row occur in ``ids``?

    ``ids`` is reduced to distinct ids first, so rows never multiply.  Ids (an
    "unknown" code, missing ids, copies of one event) that hold a large share of
    ``events`` and at least ``hot_rows`` rows never travel through a shuffle: their
    rows are looked up in a broadcast table of those ids, at most a few thousand.
    All other rows are spread evenly by the join.  Finding the hot ids is one job
    over the id columns; ``hot_rows=None`` skips it.  Ids are compared in the type
    they have in ``events``.

    ``prefilter`` is for events of which most have no partner: the distinct ids set the bits of
    an array (8 MB at most), and events whose bit is not set, or whose id is missing, get their 0
    where they are read.  Only the others are joined.  With more ids than such an
    array can tell apart it is left out; the result is the same.
    """
    on = [on] if isinstance(on, str) else list(on)
    if name in events.columns:
        raise ValueError(f"the events already have a column {name!r}")
    ids = ids.select(*[F.col(c).try_cast(events.schema[c].dataType).alias(c) for c in on])
    known = ids.dropna().distinct().withColumn(name, F.lit(1))
    misses = None
    if prefilter:
        known = stored(known)
        count = known.count()
        if count * LEAST_BITS_PER_ID <= MOST_BITS:
            bits = bits_for(count)
            may = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in on]) & may_hold(bit_array(known, on, bits), bits, *[F.col(c) for c in on])
            misses = events.filter(~may).withColumn(name, F.lit(0))
            events = events.filter(may)
    hot = hot_hashes(events, on, hot_rows) if hot_rows is not None else []
    if hot:
        is_hot = F.xxhash64(*on).isin(hot)
        spread = events.filter(~is_hot).join(known.filter(~is_hot), on, "left")
        apart = events.filter(is_hot).join(F.broadcast(known.filter(is_hot)), on, "left")
        joined = spread.unionByName(apart)
    else:
        joined = events.join(known, on, "left")
    flagged = joined.select(*events.columns, F.coalesce(F.col(name), F.lit(0)).alias(name))
    return flagged if misses is None else flagged.unionByName(misses)


def label_join(df: DataFrame, other: DataFrame, label: str, other_label: str,
               how: str = "left") -> DataFrame:
    """Join by a name instead of a code, ignoring case and outer white space; two spellings of one name raise."""
    left = df.withColumn("_label", normalized(F.col(label)))
    fresh = [c for c in other.columns if c not in (*df.columns, other_label)]
    right = one_per_key(other.select(normalized(F.col(other_label)).alias("_label"), *fresh), ["_label"])
    return left.join(right, "_label", how).drop("_label")


def unmatched_labels(df: DataFrame, other: DataFrame, label: str, other_label: str) -> DataFrame:
    """Labels of ``df`` that ``other`` does not know."""
    left = df.select(label).distinct().withColumn("_label", normalized(F.col(label)))
    right = other.select(normalized(F.col(other_label)).alias("_label")).distinct()
    return left.join(right, "_label", "left_anti").drop("_label")
