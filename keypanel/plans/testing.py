"""Test rates of persons per key: known results, killed and surviving, test types."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keypanel.functions.rates import row_sum, share
from keypanel.operators.aggregate import code_counts, count_where, profile_by_key, profile_through


@dataclass(frozen=True)
class TestCodes:
    """Column names and codes of a person table.  The defaults are fixed values."""

    __test__ = False

    person: str = "per_no"
    person_type: str | None = "per_typ"
    injury: str = "inj_sev"
    status: str = "alc_status"
    test: str = "atst_typ"
    driver: object = 1
    killed: object = 4
    known: object = 2
    not_given: object = 0
    tests: dict[str, object] = field(default_factory=lambda: {
        "n_blood": 1, "n_breath": 2, "n_urine": 3, "n_vitreous": 4, "n_pbt": 10})


def _measures(codes: TestCodes) -> dict[str, Column]:
    person = F.col(codes.person).isNotNull()
    dead = F.coalesce(F.col(codes.injury) == codes.killed, F.lit(False))
    known = F.coalesce(F.col(codes.status) == codes.known, F.lit(False))
    return {
        "total": count_where(person),
        "known": count_where(known),
        "not_given": count_where(F.col(codes.status) == codes.not_given),
        "killed": count_where(person & dead),
        "killed_known": count_where(known & dead),
        "surviving": count_where(person & ~dead),
        "surviving_known": count_where(known & ~dead),
        **code_counts(F.col(codes.test), codes.tests, "n_other", where=known),
    }


def test_rates(persons: DataFrame, key: str, codes: TestCodes = TestCodes(), share_of: str = "n_blood",
               lookup: DataFrame | None = None, via: str | None = None) -> DataFrame:
    """All counts in one aggregate, then the rates.

    A key without killed persons stays, with a NULL rate.  With ``lookup`` the
    key is found from ``via`` after persons were counted per ``via``.
    """
    drivers = persons.filter(F.col(codes.person_type) == codes.driver) if codes.person_type else persons
    if lookup is None:
        totals = profile_by_key(drivers, [key], _measures(codes))
    else:
        totals = profile_through(drivers, via, lookup, [key], _measures(codes))
    tests = [*codes.tests, "n_other"]
    n_tests = row_sum(*[F.col(t) for t in tests])
    return totals.select(
        key, "total", "known", "not_given",
        share(F.col("known"), F.col("total"), 1).alias("pct_known_all"),
        "killed", "killed_known",
        share(F.col("killed_known"), F.col("killed"), 1).alias("pct_known_killed"),
        "surviving", "surviving_known",
        share(F.col("surviving_known"), F.col("surviving"), 1).alias("pct_known_surviving"),
        *tests,
        share(F.col(share_of), n_tests, 1).alias("pct_" + share_of.removeprefix("n_")))


test_rates.__test__ = False
