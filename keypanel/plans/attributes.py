"""Coded attributes of keys from free text: enforcement, penalties, label pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keypanel.functions import rules
from keypanel.functions.rates import flag
from keypanel.functions.text import (duration_days, first_amount, last_amount, level_or_null,
                                     mentions, years_back)
from keypanel.operators.columns import ids_first, safe_name
from keypanel.operators.joins import outer_merge
from keypanel.sources.lines import label_values, plain_text

# Labels of the pages that list a key's attributes.
PAGE_LABELS = [
    "Administrative License Suspension/Revocation",
    "DUI Look-back Periods",
    "Enhanced Penalties for High-BAC",
    "Felony DUI",
    "Open Container - Alcohol",
    "Sobriety Checkpoints",
    "No Refusal Programs",
    "Ignition Interlocks",
    "DUID: Implied Consent Testing Methods",
    "ALR Laws",
    "Social Host Laws",
    "Roadside Preliminary Breath Test (PBT) Laws",
]


def page_attributes(pages: DataFrame, html: str, ids: list[str],
                    labels: list[str] = PAGE_LABELS) -> DataFrame:
    """One row per page, one text column per label; ids first, the rest by name."""
    text = pages.select(*ids, plain_text(F.col(html)).alias("_text"))
    wide = label_values(text, "_text", labels)
    return ids_first(wide.select(*ids, *[safe_name(label) for label in labels]), ids)


def enforcement_attributes(raw: DataFrame, ids: list[str]) -> DataFrame:
    """Standard categories and 0/1 flags from the raw attribute texts."""
    def category(column: str, ruleset: rules.RuleSet):
        return rules.classify(F.col(column), ruleset)

    # Names of the raw and the published columns.
    coded = raw.select(
        *ids,
        category("sobriety_checkpoints", rules.CHECKPOINTS).alias("checkpoints"),
        category("no_refusal_programs", rules.NO_REFUSAL).alias("no_refusal_status"),
        category("roadside_preliminary_breath_test_pbt_laws", rules.BREATH_TEST).alias("pbt_law"),
        category("ignition_interlocks", rules.INTERLOCK).alias("iid_mandate"),
        category("felony_dui", rules.OFFENSE_THRESHOLD).alias("felony_dui_threshold"),
        category("dui_look_back_periods", rules.LOOKBACK_WORDS).alias("lookback_years"),
        level_or_null(F.col("enhanced_penalties_for_high_bac"), "no enhanced").alias("high_bac_threshold"),
        category("open_container_alcohol", rules.OPEN_CONTAINER).alias("open_container"),
        F.col("duid_implied_consent_testing_methods").alias("testing_methods"),
        mentions(F.col("duid_implied_consent_testing_methods"), "oral").alias("allows_oral_fluid"),
        mentions(F.col("administrative_license_suspension_revocation"), "enacted").alias("als_alr_enacted"),
    )
    flags = {
        "checkpoints_permitted": F.col("checkpoints") == "permitted",
        "no_refusal_active": F.col("no_refusal_status") == "active",
        "pbt_authorized": F.col("pbt_law") == "authorized",
        "iid_all_offender": F.col("iid_mandate") == "mandatory_all",
        "has_felony_dui": F.col("felony_dui_threshold").isNotNull(),
        "has_high_bac_penalty": F.col("high_bac_threshold").isNotNull(),
        "open_container_compliant": F.col("open_container") == "federal_compliant",
    }
    return coded.withColumns({name: flag(condition) for name, condition in flags.items()})


def penalties(amounts: DataFrame, windows: DataFrame, on: str) -> DataFrame:
    """Fines, jail and suspension in numbers, outer-joined with look-back years.

    ``amounts`` has the text columns ``fines``, ``jail``, ``suspension`` and
    ``device``; ``windows`` has ``lookback``.
    """
    left = amounts.select(
        on,
        first_amount(F.col("fines")).alias("fine_min_dollars"),
        last_amount(F.col("fines")).alias("fine_max_dollars"),
        duration_days(F.col("jail")).alias("jail_min_days"),
        duration_days(F.col("suspension")).alias("suspension_days"),
        rules.classify(F.col("device"), rules.DEVICE_RULE).alias("device_category"))
    right = windows.select(on, years_back(F.col("lookback")).alias("lookback_years"))
    return outer_merge(left, right, on)


def mandatory(law, kind):
    """1 when a law exists and is mandatory."""
    return F.when((law == "yes") & (kind == "mandatory"), 1).otherwise(0)
