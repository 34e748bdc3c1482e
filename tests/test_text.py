"""Text to numbers and categories, one table of cases per function."""

import pytest
from pyspark.sql import functions as F

from keypanel.functions import rules, text


def evaluate(spark, expression, values, type_name="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, t {type_name}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("t"))).collect()]


CASES = [
    (text.first_amount, {"$600–$2,100": 600.0, "$1,500+": 1500.0, "varies": None, "$,": None, None: None}),
    (text.last_amount, {"$600–$2,100": 2100.0, "$1,500+": 1500.0, "varies": None, None: None}),
    (text.duration_days, {
        "10–180 days": 10.0, "3–180 days": 3.0, "48 hrs–6 months": 2.0, "48–72 hrs": 2.0, "Up to 1 year": 365.0,
        "10 days min.": 10.0, "None (standard)": 0.0, "1.5 years": 547.5, "banana": None, "6 months": 180.0,
        "72 hrs min.": 3.0, "90 days": 90.0, " 24 Hours ": 1.0, "up to 6–12 months": 180.0, "2 fortnights": 2.0, None: None}),
    (text.years_back, {"10 years": 10, "Lifetime": 99, "7 year window": 7, "varies": None, None: None}),
    (text.number, {"−86.8287": -86.8287, " 1.5 ": 1.5, "abc": None, "1d": None, "NaN": None, "1e3": 1000.0, "": None}),
    (text.whole_number, {"3.7": 4, "12": 12, "x": None, "2.5": 3, None: None}),
    (text.pad_key, {"1": "01", "12": "12", "123": "123", None: None}),
    (text.null_tokens, {"NA": None, "": None, "ok": "ok", None: None}),
    (text.trimmed, {"\t a b \n": "a b", "": "", None: None}),
    (lambda c: text.mentions(c, "oral"), {"Blood, Oral Fluids": 1, "Blood": 0, None: 0}),
    (lambda c: text.level_or_null(c, "no enhanced"), {
        "0.15": 0.15, "No enhanced penalties": None, "abc": None, None: None}),
    (lambda c: rules.classify(c, rules.DEVICE_RULE), {
        "All offenders": "all_offenders", "Repeat only": "repeat_only", "High BAC": "high_bac", "Judge": "other",
        None: "unknown"}),
    (lambda c: rules.classify(c, rules.CHECKPOINTS), {
        "Permitted": "permitted", "Prohibited by case law": "prohibited", "No statutory authority": "no_authority",
        " ALTERNATIVE programs": "alternative", "x": "unknown", None: None}),
    (lambda c: rules.classify(c, rules.NO_REFUSAL), {
        "State utilizes it": "active", "State has legal authority": "authorized", "lacks authority": "not_authorized",
        "x": "unknown", None: None}),
    (lambda c: rules.classify(c, rules.BREATH_TEST), {
        "Statute permits it": "authorized", "doesn't explicitly permit": "not_explicit",
        "not explicitly named": "not_explicit", "x": "unknown", None: None}),
    (lambda c: rules.classify(c, rules.INTERLOCK), {
        "Mandatory all offender": "mandatory_all", "Mandatory high-BAC and repeat": "mandatory_high_bac_repeat",
        "Mandatory repeat": "mandatory_repeat", "Incentivized first": "incentivized_first_mandatory_repeat",
        "Discretionary": "discretionary", "x": "unknown", None: None}),
    (lambda c: rules.classify(c, rules.OFFENSE_THRESHOLD), {
        "Second offense": 2, "Third": 3, "Fourth": 4, "No felony DUI": None, "x": None, None: None}),
    (lambda c: rules.classify(c, rules.LOOKBACK_WORDS), {
        "Ten years": 10, "Fifty five years": 55, "Seventy five years": 75, "Five years": 5, "Fifteen years": 15,
        "Twelve years": 12, "Seven years": 7, "Lifetime": 99, "x": None, None: None}),
    (lambda c: rules.classify(c, rules.OPEN_CONTAINER), {
        "In compliance": "federal_compliant", "Does not meet": "non_compliant", "x": "unknown", None: None}),
]


@pytest.mark.parametrize("index", range(len(CASES)))
def test_cases(spark, index):
    function, cases = CASES[index]
    assert evaluate(spark, function, list(cases)) == list(cases.values())


def test_rule_result_is_a_category_or_the_default(spark):
    texts = ["all", "repeat offender", "high bac, all", "", "αβγ", None, "REPEAT"]
    allowed = {*rules.DEVICE_RULE.results(), rules.DEVICE_RULE.default, rules.DEVICE_RULE.missing}
    assert set(evaluate(spark, lambda c: rules.classify(c, rules.DEVICE_RULE), texts)) <= allowed


def test_penalty_class(spark, rows):
    df = spark.createDataFrame([(1, 2, 500), (2, 2, None), (3, 0, 500), (4, None, None)], "i int, jail int, fine int")
    found = rows(df.select("i", rules.penalty_class(F.col("jail"), F.col("fine"))), "i")
    assert [c for _, c in found] == ["both_jail_and_fine", "mandatory_jail_only", "fine_only", "minimal"]
