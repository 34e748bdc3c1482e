"""Prior history and exposure speed of vehicles, per key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keypanel.functions.rates import share
from keypanel.operators.aggregate import known_codes, median_of_counts, sum_where
from keypanel.operators.joins import exists_flag

# History codes that mean "unknown", the first speed code that is not
# a speed, and the speed from which a road counts as fast.
UNKNOWN_HISTORY = [98, 99, 998]
NOT_A_SPEED = 98
FAST = 55


def history_profile(vehicles: DataFrame, impaired: DataFrame, key: str, vehicle_id: list[str],
                    prior: str, speed: str, unknown: list = UNKNOWN_HISTORY,
                    speed_below: float = NOT_A_SPEED, fast_from: float = FAST,
                    lookup: DataFrame | None = None, via: str | None = None) -> DataFrame:
    """Known histories with a prior, for all and for impaired vehicles, and speeds.

    Vehicles are first counted per key, code, speed and flag: a short list of
    combinations, so a hot key is a few rows per map task.  With ``lookup`` the key
    is found from ``via``.  An unknown code leaves the vehicle out; a NULL code
    does not.
    """
    flagged = exists_flag(vehicles, impaired, vehicle_id, "is_impaired")
    kinds = [prior, speed, "is_impaired"]
    if lookup is not None:
        flagged = flagged.join(lookup, via)
    counted = flagged.groupBy(key, *kinds).agg(F.count("*").alias("_n"))

    n, code = F.col("_n"), F.col(prior)
    known, has_prior = known_codes(code, unknown), F.coalesce(code > 0, F.lit(False))
    hit = F.col("is_impaired") == 1
    valid = (F.col(speed) > 0) & (F.col(speed) < speed_below)
    rows = counted.dropna(subset=[key]).withColumn("_speed", F.when(valid, F.col(speed)))
    totals = rows.groupBy(key).agg(
        sum_where(n, known).alias("known_history"),
        sum_where(n, known & has_prior).alias("with_prior"),
        sum_where(n, known & hit).alias("impaired_known_history"),
        sum_where(n, known & hit & has_prior).alias("impaired_with_prior"),
        sum_where(n, valid).alias("n_speed"),
        sum_where(n, valid & (F.col(speed) >= fast_from)).alias("n_fast"),
        F.sum((F.col("_speed") * n).cast("decimal(28,4)")).cast("double").alias("_speed_sum"),
        median_of_counts("_speed", "_n").alias("median_speed"))
    return totals.select(
        key, "known_history", "with_prior", "impaired_known_history", "impaired_with_prior",
        share(F.col("impaired_with_prior"), F.col("impaired_known_history"), 1).alias("pct_impaired_with_prior"),
        share(F.col("with_prior"), F.col("known_history"), 1).alias("pct_all_with_prior"),
        "median_speed",
        F.round(F.try_divide(F.col("_speed_sum"), F.col("n_speed")), 1).alias("mean_speed"),
        share(F.col("n_fast"), F.col("n_speed"), 1).alias("pct_fast"))


def prior_share_by_threshold(profile: DataFrame, keys: DataFrame, key: str, threshold: str) -> DataFrame:
    """Impaired with and without a prior, keys grouped by threshold; ratio of sums."""
    joined = keys.join(profile, key)
    label = F.coalesce(F.col(threshold).cast("string"), F.lit("none")).alias("threshold")
    with_prior, total = F.sum("impaired_with_prior"), F.sum("impaired_known_history")
    return joined.groupBy(label).agg(
        F.count("*").alias("keys"), with_prior.alias("with_prior"),
        (total - with_prior).alias("without_prior"),
        share(with_prior, total, 1).alias("pct_with_prior"))
