"""First-match substring rules: ordered needles that map free text to a category."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from keypanel.functions.text import normalized


@dataclass(frozen=True)
class RuleSet:
    """``rules`` are tried in order; a rule matches when any of its needles occurs.

    ``default`` is the result when nothing matches, ``missing`` the result for
    NULL text.
    """

    rules: tuple[tuple[tuple[str, ...], Any], ...]
    default: Any = None
    missing: Any = None
    type_name: str = "string"

    def results(self) -> list:
        return [result for _, result in self.rules]


def longest_first(needles: dict[str, Any], **options: Any) -> RuleSet:
    """Rules whose needles contain each other: the longest one is tried first."""
    ordered = sorted(needles.items(), key=lambda item: -len(item[0]))
    return RuleSet(tuple(((needle,), result) for needle, result in ordered), **options)


def classify(column: Column, rules: RuleSet) -> Column:
    """One CASE expression over the normalized text."""
    text = normalized(column)
    case = F.when(text.isNull(), F.lit(rules.missing).cast(rules.type_name))
    for needles, result in rules.rules:
        hit = F.lit(False)
        for needle in needles:
            hit = hit | text.contains(needle)
        case = case.when(hit, F.lit(result).cast(rules.type_name))
    return case.otherwise(F.lit(rules.default).cast(rules.type_name))


# ---------------------------------------------------------------------------
# The needles and categories of the standard attributes.
# ---------------------------------------------------------------------------

DEVICE_RULE = RuleSet(
    ((("all",), "all_offenders"), (("repeat",), "repeat_only"), (("high bac",), "high_bac")),
    default="other", missing="unknown")

CHECKPOINTS = RuleSet(
    ((("permitted",), "permitted"), (("prohibited",), "prohibited"),
     (("no statutory",), "no_authority"), (("alternative",), "alternative")),
    default="unknown")

NO_REFUSAL = RuleSet(
    ((("utilizes",), "active"), (("has legal authority",), "authorized"),
     (("lacks",), "not_authorized")),
    default="unknown")

BREATH_TEST = RuleSet(
    ((("statute permits",), "authorized"),
     (("doesn't explicitly", "not explicitly"), "not_explicit")),
    default="unknown")

INTERLOCK = RuleSet(
    ((("mandatory all offender",), "mandatory_all"),
     (("mandatory high-bac and repeat",), "mandatory_high_bac_repeat"),
     (("mandatory repeat",), "mandatory_repeat"),
     (("incentivized",), "incentivized_first_mandatory_repeat"),
     (("discretionary",), "discretionary")),
    default="unknown")

OFFENSE_THRESHOLD = RuleSet(
    ((("no felony",), None), (("second",), 2), (("third",), 3), (("fourth",), 4)),
    type_name="int")

LOOKBACK_WORDS = longest_first(
    {"five years": 5, "seven years": 7, "ten years": 10, "twelve years": 12,
     "fifteen years": 15, "fifty five years": 55, "seventy five years": 75,
     "lifetime": 99},
    type_name="int")

OPEN_CONTAINER = RuleSet(
    ((("in compliance",), "federal_compliant"), (("does not meet",), "non_compliant")),
    default="unknown")


# The class of a row that has both, either or neither.
PENALTY_CLASSES = {"both": "both_jail_and_fine", "jail": "mandatory_jail_only", "fine": "fine_only", "neither": "minimal"}


def penalty_class(jail: Column, fine: Column) -> Column:
    """Class of a row from two numbers; an unknown number counts as absent."""
    jailed, fined = F.coalesce(jail > 0, F.lit(False)), F.coalesce(fine > 0, F.lit(False))
    return (F.when(jailed & fined, PENALTY_CLASSES["both"])
            .when(jailed, PENALTY_CLASSES["jail"])
            .when(fined, PENALTY_CLASSES["fine"])
            .otherwise(PENALTY_CLASSES["neither"]))
