"""Number and boolean repair (N1-N7). Bad text becomes NULL, it never raises."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(12,2)"


_NUMBER_TEXT = r"^([+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?)$"


def clean_number(c: Column) -> Column:
    """Double from text carrying `$`, thousands commas or `USD`; anything else is NULL.

    The text is checked before the cast, because a cast also reads `NaN`, `Infinity` and `1d`. What is too large for a
    double is NULL too. The expression mentions its argument once, so plans that inline it do not multiply.
    """
    bare = F.trim(F.regexp_replace(c.cast("string"), r"\$|,|USD", ""))
    value = F.regexp_extract(bare, _NUMBER_TEXT, 1).try_cast("double")
    return F.get(F.filter(F.array(value), lambda x: F.abs(x) < float("inf")), F.lit(0))


def numeric_or_null(c: Column) -> Column:
    """Double only from plain digits with an optional sign and point."""
    return F.when(F.rlike(c, F.lit(r"^-?\d+\.?\d*$")), c.try_cast("double"))


def round_money(c: Column, digits: int = 2) -> Column:
    return F.round(c, digits)


def to_money(c: Column) -> Column:
    return c.try_cast(MONEY)


def non_negative(c: Column, policy: str = "null") -> Column:
    """Values at or below zero become NULL (`null`) or their magnitude (`abs`)."""
    if policy == "abs":
        return F.abs(c)
    if policy == "null":
        return F.when(c > 0, c)
    raise ValueError(f"unknown policy {policy!r}")


def in_range(c: Column, low, high) -> Column:
    return F.when(c.between(low, high), c)


def to_bool(c: Column) -> Column:
    return F.trim(c).try_cast("boolean")
