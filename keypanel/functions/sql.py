"""The library's scalar functions for SQL text: plain SQL bodies, which Spark puts into the plan.

``register(spark)`` makes them temporary functions of the session.  They give what the
column functions of ``rates`` and ``text`` give; rates are rounded half up to two digits.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from keypanel.functions.text import DAYS_PER_UNIT, DOLLAR, HOUR_WORDS, HOURS_PER_DAY, LIFETIME, PLAIN_NUMBER, WHITESPACE, YEARS


def _text(value: str) -> str:
    """A text as an SQL literal."""
    return "'" + "".join(f"\\u{ord(c):04x}" if ord(c) < 32 or ord(c) > 126 or c in "'\\" else c for c in value) + "'"


_AMOUNT = f"CASE WHEN {{0}} RLIKE {_text(PLAIN_NUMBER)} THEN try_cast({{0}} AS DOUBLE) END"
_NUMBER_IN = f"btrim(translate({{0}}, {_text(chr(0x2212))}, '-'), {_text(WHITESPACE)})"
_TRIMMED = f"btrim(lower(t), {_text(WHITESPACE)})"
_LEAD, _DASH = r"^(?:up to\s+)?", "[\u2013\u2212-]"


def _first_of(pattern: str) -> str:
    return f"regexp_extract({_TRIMMED}, {_text(pattern)}, 1)"


def _duration() -> str:
    value = _AMOUNT.format(_first_of(_LEAD + r"(\d+\.?\d*|\.\d+)"))
    own, shared = _first_of(_LEAD + r"[\d.]+\s*([a-z]+)"), _first_of(_LEAD + rf"[\d.]+\s*{_DASH}\s*[\d.]+\s*([a-z]+)")
    unit = f"CASE WHEN {own} <> '' THEN {own} ELSE {shared} END"
    cases = [f"WHEN contains({unit}, '{word}') THEN ({value}) * {days}D" for word, days in DAYS_PER_UNIT.items()]
    cases += [f"WHEN contains({unit}, '{word}') THEN ({value}) / {HOURS_PER_DAY}D" for word in HOUR_WORDS]
    return f"CASE WHEN startswith({_TRIMMED}, 'none') THEN 0D {' '.join(cases)} ELSE {value} END"


# Name, parameters, result and body.
FUNCTIONS = (
    ("panel_rate", "part DOUBLE, whole DOUBLE, per DOUBLE", "DOUBLE", "round(try_divide(part * per, whole), 2)"),
    ("panel_share", "part DOUBLE, whole DOUBLE", "DOUBLE", "round(try_divide(part * 100D, whole), 2)"),
    ("panel_flag", "condition BOOLEAN", "INT", "CAST(coalesce(condition, false) AS INT)"),
    ("panel_sufficient", "n BIGINT, least BIGINT", "INT", "CAST(coalesce(n, 0) >= least AS INT)"),
    ("panel_pad", "code STRING, width INT", "STRING", "CASE WHEN length(code) < width THEN lpad(code, width, '0') ELSE code END"),
    ("panel_number", "t STRING", "DOUBLE", _AMOUNT.format(_NUMBER_IN.format("t"))),
    ("panel_first_amount", "t STRING", "DOUBLE", _AMOUNT.format(f"replace(regexp_extract(t, {_text(DOLLAR)}, 1), ',', '')")),
    ("panel_last_amount", "t STRING", "DOUBLE", _AMOUNT.format(f"replace(try_element_at(regexp_extract_all(t, {_text(DOLLAR)}, 1), -1), ',', '')")),
    ("panel_duration_days", "t STRING", "DOUBLE", _duration()),
    ("panel_years_back", "t STRING", "INT", f"coalesce(try_cast(nullif(regexp_extract(lower(t), {_text(YEARS)}, 1), '') AS INT), "
                                            f"CASE WHEN contains(lower(t), 'lifetime') THEN {LIFETIME} END)"),
    ("panel_mentions", "t STRING, needle STRING", "INT", "CAST(coalesce(contains(lower(t), needle), false) AS INT)"),
)


def register(spark: SparkSession) -> list[str]:
    """Make the functions known to the session's SQL; returns their names."""
    for name, parameters, result, body in FUNCTIONS:
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {result} RETURN {body}")
    return [f[0] for f in FUNCTIONS]
