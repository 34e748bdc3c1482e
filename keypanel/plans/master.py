"""Rates tables and wide tables with one row per key."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keypanel.functions.rates import rate, round_floats
from keypanel.operators.joins import wide_join


@dataclass(frozen=True)
class RateSpec:
    """A derived rate: ``numerator * per / denominator`` with ``digits`` digits."""

    name: str
    numerator: str
    denominator: str
    per: float = 100_000.0
    digits: int = 2

    def column(self) -> Column:
        return rate(F.col(self.numerator), F.col(self.denominator), self.per, self.digits).alias(self.name)


def rates_table(spine: DataFrame, required: DataFrame, optional: list[DataFrame], key: str,
                labels: list[str], specs: list[RateSpec], keep: tuple[str, ...] = ()) -> DataFrame:
    """Rates per key: keys without the required outcomes drop out, optional ones are NULL."""
    base = wide_join(spine.join(required, key), [(df, key) for df in optional])
    return base.select(key, *labels, *[s.column() for s in specs], *keep)


def wide_master(spine: DataFrame, parts: list[tuple[DataFrame, str | list[str]]],
                derived: dict[str, Column] | None = None, drop: tuple[str, ...] = (),
                order_by: str | None = None, digits: int | None = None) -> DataFrame:
    """Spine with all parts, derived columns, helper columns dropped, floats rounded."""
    wide = wide_join(spine, parts)
    if derived:
        wide = wide.withColumns(derived)
    wide = wide.drop(*drop)
    if digits is not None:
        wide = round_floats(wide, digits)
    return wide.orderBy(order_by) if order_by else wide
