"""Free text to numbers, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# All white space of the Unicode standard, no-break spaces included.
WHITESPACE = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())

# What a dollar amount, a year count and a plain number look like.
DOLLAR = r"\$([\d,]+)"
YEARS = r"(\d+)\s*year"
PLAIN_INTEGER = r"^[+-]?\d+$"
PLAIN_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"

# Days per unit and hours per day; a unit is found as part of its word,
# any other word counts as days.
DAYS_PER_UNIT = {"year": 365.0, "month": 30.0, "day": 1.0}
HOUR_WORDS = ("hr", "hour")
HOURS_PER_DAY = 24.0

# Fixed value: years recorded for "lifetime".
LIFETIME = 99

_UNICODE_MINUS = "−"
_DASH = r"[–−-]"


def trimmed(column: Column) -> Column:
    """Strip all leading and trailing white space, not only blanks."""
    return F.btrim(column, F.lit(WHITESPACE))


def normalized(column: Column) -> Column:
    """Lower case without surrounding white space: the form rules are matched on."""
    return trimmed(F.lower(column))


def plain_minus(column: Column) -> Column:
    """Replace the Unicode minus sign by the ASCII one."""
    return F.translate(column, _UNICODE_MINUS, "-")


def number(column: Column) -> Column:
    """Text as a double, NULL when it is not a plain number."""
    text = trimmed(plain_minus(column.cast("string")))
    return F.when(text.rlike(PLAIN_NUMBER), text.try_cast("double"))


def whole_number(column: Column, type_name: str = "int") -> Column:
    """Text as an integer; fractions are rounded instead of becoming NULL."""
    # Only text of the right form is cast: a failing cast costs an exception per row.
    text = trimmed(column.cast("string"))
    exact = F.when(text.rlike(PLAIN_INTEGER), text.try_cast(type_name))
    return F.coalesce(exact, F.round(number(column)).try_cast(type_name))


def pad_key(column: Column, width: int = 2) -> Column:
    """Left-pad a code with zeros; longer codes stay whole."""
    text = column.cast("string")
    return F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text)


def null_tokens(column: Column, tokens: tuple[str, ...] = ("", "NA", "N/A", "NaN", "null", "None")) -> Column:
    """Turn spelled-out missing values into NULL."""
    return F.when(~trimmed(column).isin(*tokens), column)


def _amount(text: Column) -> Column:
    return number(F.replace(text, F.lit(","), F.lit("")))


def first_amount(column: Column) -> Column:
    """First dollar amount of a text: the low end of a range."""
    return _amount(F.regexp_extract(column, DOLLAR, 1))


def last_amount(column: Column) -> Column:
    """Last dollar amount of a text: the high end of a range."""
    found = F.regexp_extract_all(column, F.lit(DOLLAR), F.lit(1))
    return _amount(F.try_element_at(found, F.lit(-1)))


def duration_days(column: Column) -> Column:
    """Duration text in days.

    A range gives its low end in that end's own unit; when only the high end
    names a unit ("10-180 days") the low end shares it.  Text that starts with
    "none" is zero days.
    """
    text = normalized(column)
    lead = r"^(?:up to\s+)?"
    value = number(F.regexp_extract(text, lead + r"(\d+\.?\d*|\.\d+)", 1))
    own_unit = F.regexp_extract(text, lead + r"[\d.]+\s*([a-z]+)", 1)
    range_unit = F.regexp_extract(text, lead + rf"[\d.]+\s*{_DASH}\s*[\d.]+\s*([a-z]+)", 1)
    unit = F.when(own_unit != "", own_unit).otherwise(range_unit)
    days = F.when(text.startswith("none"), F.lit(0.0))
    for word, length in DAYS_PER_UNIT.items():
        days = days.when(unit.contains(word), value * length)
    for word in HOUR_WORDS:
        days = days.when(unit.contains(word), value / HOURS_PER_DAY)
    return days.otherwise(value)


def years_back(column: Column) -> Column:
    """"N years" as N, "lifetime" as 99, anything else NULL."""
    text = F.lower(column)
    return F.coalesce(
        F.nullif(F.regexp_extract(text, YEARS, 1), F.lit("")).try_cast("int"),
        F.when(text.contains("lifetime"), F.lit(LIFETIME)),
    )


def level_or_null(column: Column, absent: str) -> Column:
    """A numeric level, NULL where the text says there is none."""
    return F.when(~normalized(column).contains(absent), number(column))


def mentions(column: Column, needle: str) -> Column:
    """Case-insensitive "contains" as 0/1, missing text as 0."""
    return F.coalesce(F.lower(column).contains(needle), F.lit(False)).cast("int")
