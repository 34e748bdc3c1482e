"""Exact quantiles in two passes, without gathering a group in one place."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

# Size of a sketch, which holds about three times as many values at most, and by how many
# times its stated error (at 99 % confidence) a bracket is wider than the rank it is for.
SKETCH = 4096
MARGIN = 4
# Keys whose brackets go to every task: at some 400 bytes each, 20 MB at most.
BROADCAST_KEYS = 50_000
# Ranks that rounding may cost at either end, four times over.
ROUNDING = 12


def rank_error(k: int) -> float:
    """The part of a group's rows by which a rank in a sketch of size ``k`` may be wrong."""
    return 2.296 / k ** 0.9021


def exact_quantiles(df: DataFrame, keys: list[str], value: str, probs: dict[str, float],
                    also: dict[str, Column] | None = None, k: int = SKETCH, *, few_keys: bool | None = None) -> DataFrame:
    """Exact, linearly interpolated quantiles of ``value`` per key.

    The first pass makes a mergeable sketch per key, combined on the map side, which
    brackets each quantile between two values.  The second counts the rows below a bracket and
    the copies of each value inside it, again combined on the map side; only these values are
    put in order.  A bracket holds ``2 * MARGIN * rank_error(k)`` of the rows of its key,
    about one in a hundred; a larger ``k`` makes it narrower.  The rank
    that is wanted lies inside with a probability that leaves chance out of account (seven
    standard deviations or more); should it not, the job fails and says so.  It is
    one lazy plan of two scans and four exchanges, the same for all sizes.

    Rows meet the brackets of few keys where they are read; no raw row is shuffled then.  Whether keys are
    few (``BROADCAST_KEYS``) is counted by a sketch, in one job that reads the key columns, unless
    ``few_keys`` says it.  Otherwise both sides are shuffled, with one more exchange, and Spark splits
    a partition that a hot key makes large.

    ``also`` names further aggregates per key over the column ``value``.  The result
    has one row per key, with ``also`` and ``probs``; quantiles are NULL for a key
    without values.  NaN counts as missing.
    """
    number = F.col(value).cast("double")
    ids = [f"_k{i}" for i in range(len(keys))]
    rows = df.select(F.struct(*[F.col(c).alias(i) for c, i in zip(keys, ids)]).alias("_key"),
                     F.when(~F.isnan(number), number).alias("value"))
    extra = [column.alias(f"_a{i}") for i, column in enumerate((also or {}).values())]
    groups = rows.groupBy("_key").agg(F.count("value").alias("_n"), F.kll_sketch_agg_double("value", k).alias("_sketch"), *extra)
    positions = [(F.col("_n") - 1) * F.lit(float(q)) for q in probs.values()]
    brackets = groups.select("_key", "_n", F.struct(F.lit(0).alias("_"), *[f"_a{i}" for i in range(len(extra))]).alias("_also"),
                             F.when(F.col("_n") > 0, F.array(*[_bracket(q, k) for q in probs.values()])).alias("_in"))

    v = F.col("value")
    places = [F.when(v <= F.col("_in")[i]["high"], F.struct(F.lit(i).alias("i"), F.when(v >= F.col("_in")[i]["low"], v).alias("value")))
              for i in range(len(probs))]
    missing = F.when(v.isNull(), F.struct(F.lit(-1).alias("i"), v.alias("value")))  # keeps keys without values
    if few_keys is None:
        few_keys = not keys or _are_few(rows)
    if few_keys:
        met = rows.join(F.broadcast(brackets), "_key")
    else:  # 0 in every row, so that an exchange stands on both sides of the join
        nought = F.pmod(F.xxhash64("_key"), F.lit(1)).alias("_nought")
        met = rows.select("*", nought).join(brackets.select("*", nought).hint("merge"), ["_key", "_nought"])
    # The key built again stands for an exchange behind the join: many tasks count the rows of one key.
    own_key = F.struct(*[F.col(f"_key.{i}").alias(i) for i in ids])
    counts = (met.select("_key", "_n", "_also", F.explode(F.array(missing, *places)).alias("_p")).where("_p IS NOT NULL")
              .select(own_key.alias("_key"), "_n", "_also", F.col("_p.i").alias("_i"), F.col("_p.value").alias("value"))
              .groupBy("_key", "_n", "_also", "_i", "value").agg(F.count("*").alias("_size")))

    # A bracket's row without a value counts the rows below it and comes first.
    order = W.partitionBy("_key", "_i").orderBy(F.asc_nulls_first("value")).rowsBetween(W.unboundedPreceding, W.currentRow)
    ordered = counts.repartition("_key").withColumn("_end", F.sum("_size").over(order))
    ends = []
    for i, position in enumerate(positions):
        for rank, name in ((F.floor(position), f"_low{i}"), (F.ceil(position), f"_high{i}")):
            here = (F.col("_i") == i) & (F.col("_end") - F.col("_size") <= rank) & (rank < F.col("_end"))
            ends.append(F.max(F.when(here, v)).alias(name))
    found = ordered.groupBy("_key", "_n", "_also").agg(*ends)

    result = [F.col(f"_key.{i}").alias(c) for i, c in zip(ids, keys)]
    result += [F.col(f"_also._a{i}").alias(name) for i, name in enumerate(also or {})]
    for i, (name, position) in enumerate(zip(probs, positions)):
        low, high = F.col(f"_low{i}"), F.col(f"_high{i}")
        part = position - F.floor(position)
        endless = (low == float("-inf")) & (high < float("inf"))
        missed = (F.col("_n") > 0) & (low.isNull() | high.isNull())
        between = F.when((low == high) | (part == 0) | endless, low).otherwise(low + (high - low) * part)
        result.append(F.when(missed, F.raise_error(F.lit(f"a rank of {name} is not in its bracket; use a larger sketch"))).otherwise(between).alias(name))
    return found.select(*result)


def _are_few(rows: DataFrame) -> bool:
    return rows.agg(F.approx_count_distinct("_key")).first()[0] <= BROADCAST_KEYS


def _bracket(q: float, k: int) -> Column:
    """Two values of the sketch that a quantile lies between."""
    wide = MARGIN * rank_error(k)

    def at(rank: float) -> Column:
        return F.kll_sketch_get_quantile_double("_sketch", F.lit(min(max(rank, 0.0), 1.0)))

    few = F.col("_n") < ROUNDING / wide  # ranks are whole numbers: a small group counts as a whole
    return F.struct(F.when(few, at(0.0)).otherwise(at(q - wide)).alias("low"), F.when(few, at(1.0)).otherwise(at(q + wide)).alias("high"))
