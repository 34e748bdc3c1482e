"""Rates, shares, flags and rounding."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def rounded(value: Column, digits: int, mode: str = "half_up") -> Column:
    """Round half up (SQL ``ROUND``) or, with ``mode="even"``, half to even."""
    return F.bround(value, digits) if mode == "even" else F.round(value, digits)


def fixed_round(value: Column, digits: int) -> Column:
    """Round a ratio at three or more digits.

    Going through a decimal keeps binary noise from moving a value across a
    rounding boundary.  Numbers that no decimal of three more digits can hold are rounded as doubles.
    """
    decimal = F.round(value.try_cast(f"decimal(38,{digits + 3})"), digits).cast("double")
    return F.coalesce(decimal, F.round(value.cast("double"), digits))


def rate(num: Column, den: Column, per: float = 1.0, digits: int = 2,
         mode: str = "half_up") -> Column:
    """``num * per / den`` rounded; NULL when the denominator is NULL or zero."""
    scaled = num.cast("double") * F.lit(float(per))
    return rounded(F.try_divide(scaled, den.cast("double")), digits, mode)


def share(part: Column, whole: Column, digits: int = 2) -> Column:
    """Percentage of ``part`` in ``whole``."""
    return rate(part, whole, 100.0, digits)


def flag(condition: Column) -> Column:
    """A condition as 0/1, where unknown counts as 0."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def sufficient(count: Column, minimum: int) -> Column:
    """1 when a sample holds at least ``minimum`` rows; a missing count is 0 rows."""
    return (F.coalesce(count, F.lit(0)) >= F.lit(minimum)).cast("int")


def row_sum(*columns: Column) -> Column:
    """Sum across columns of one row, missing values as 0."""
    return reduce(lambda a, b: a + b, [F.coalesce(c, F.lit(0)) for c in columns])


def not_in_keeping_null(column: Column, values: list) -> Column:
    """``NOT IN`` that keeps rows whose value is NULL."""
    return column.isNull() | ~column.isin(*values)


def money(column: Column) -> Column:
    """Exact decimal of an amount whose unit has two decimals; not for other measures."""
    return column.cast("decimal(18,2)")


# Bits of a part of a number, and of the pieces a part is added up in: the sum of the pieces of
# eight million million rows still is a 64-bit integer.
PART_BITS, PIECE_BITS = 60, 20


def stable_sum(column: Column) -> Column:
    """Sum of any measure as a double that does not depend on the order of rows.

    A double is cut into its whole number and two parts of 60 bits behind the point, each
    exact, and integers are added up; nothing is rounded before the end.  So values from 1e-20 to 1e18
    are added exactly.  Smaller and larger ones, infinities and NaN are added as doubles.
    The result keeps fifteen significant digits, so amounts written in decimals sum to what
    their decimals sum to.  NULL when there is no value.
    """
    number = column.cast("double")
    size = F.abs(number)
    usual = (size < 2.0 ** PART_BITS) & ((size >= 2.0 ** -(2 * PART_BITS - 53)) | (size == 0))
    inside = F.when(usual, number).otherwise(F.lit(0.0))
    whole = inside.cast("bigint")
    behind = (inside - whole) * (2.0 ** PART_BITS)
    first = behind.cast("bigint")
    second = ((behind - first) * (2.0 ** PART_BITS)).cast("bigint")
    total = _exact_sum(whole) + _exact_sum(first) * 2.0 ** -PART_BITS + _exact_sum(second) * 2.0 ** (-2 * PART_BITS)
    others = F.coalesce(F.sum(F.when(~usual, number)), F.lit(0.0))
    return F.when(F.count(number) > 0, F.format_string("%.14e", total + others).cast("double"))


def _exact_sum(part: Column) -> Column:
    """Sum of integers of up to 60 bits, added in pieces that cannot overflow."""
    mask = F.lit((1 << PIECE_BITS) - 1).cast("bigint")
    pieces = [F.sum(part.bitwiseAND(mask)), F.sum(F.shiftright(part, PIECE_BITS).bitwiseAND(mask)), F.sum(F.shiftright(part, 2 * PIECE_BITS))]
    exact = [(p.cast("decimal(38,0)") * F.lit(1 << (i * PIECE_BITS)).cast("decimal(13,0)")).cast("decimal(38,0)") for i, p in enumerate(pieces)]
    return reduce(lambda a, b: a + b, exact).cast("double")


def round_floats(df: DataFrame, digits: int = 2, mode: str = "half_up") -> DataFrame:
    """Round every float column and leave the others as they are."""
    floats = (T.DoubleType, T.FloatType)
    return df.select(*[
        rounded(F.col(f"`{f.name}`"), digits, mode).alias(f.name)
        if isinstance(f.dataType, floats) else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ])
