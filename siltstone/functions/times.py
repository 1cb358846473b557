"""Time parsing and arithmetic (D1-D8). Bad text becomes NULL, it never raises."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone import vocab


#: The largest epoch value that a timestamp (64-bit microseconds), or a date (32-bit days), can hold.
_EPOCH_MAX = {"s": (1 << 63) // 10**6 - 1, "ms": (1 << 63) // 10**3 - 1, "us": (1 << 63) - 1, "d": (1 << 31) - 1}


def epoch_to_ts(c: Column, unit: str = "ms") -> Column:
    """Integer since the epoch -> timestamp (`s`, `ms`, `us`) or date (`d`); NULL beyond what these can hold, of either sign."""
    makers = {
        "s": F.timestamp_seconds,
        "ms": F.timestamp_millis,
        "us": F.timestamp_micros,
        "d": lambda x: F.date_from_unix_date(x.cast("int")),
    }
    value = c.try_cast("bigint")
    return makers[unit](F.when(value.between(-_EPOCH_MAX[unit], _EPOCH_MAX[unit]), value))


def _epoch_text(c: Column, unit: str = "s") -> Column:
    """Timestamp from text made of digits only, counted in `unit`; NULL beyond what a timestamp can hold."""
    return epoch_to_ts(F.when(F.rlike(c, F.lit(r"^\d+$")), c), unit)


_TOKEN_SHAPES = {
    "yyyy": r"\d{4}", "MMM": "[A-Za-z]{3}", "MM": r"\d{2}", "dd": r"\d{2}", "d": r"\d{1,2}",
    "HH": r"\d{2}", "mm": r"\d{2}", "ss": r"\d{2}",
}


def _shape(pattern: str) -> str:
    """Regular expression of the texts a date pattern can fit."""
    tokens = re.findall("|".join([*_TOKEN_SHAPES, "."]), pattern)
    return "^" + "".join(_TOKEN_SHAPES.get(t, re.escape(t)) for t in tokens) + "$"


def _by_format(text: Column, pattern: str) -> Column:
    """Timestamp where the text fits the pattern, else NULL.

    The shape is checked before the parser is called: a parser that meets the wrong shape raises
    and catches an exception per row, and tries the old calendar's parser on top.
    """
    return F.when(F.rlike(text, F.lit(_shape(pattern))), F.try_to_timestamp(text, F.lit(pattern)))


def parse_mixed_ts(c: Column, unit: str = "s") -> Column:
    """`yyyy-MM-dd HH:mm:ss`, else digits as an epoch value (seconds unless `unit` says otherwise), else NULL."""
    text = F.trim(c)
    return F.coalesce(_by_format(text, vocab.DATETIME_FORMAT), _epoch_text(text, unit))


def parse_date_formats(
    c: Column, formats: Sequence[str] = vocab.DATE_FORMATS, *, epoch: bool = True, unit: str = "s"
) -> Column:
    """First format that fits, else (with `epoch`) digits as an epoch value in `unit`, else NULL."""
    text = F.trim(c)
    tries = [_by_format(text, f) for f in formats]
    if epoch:
        tries.append(_epoch_text(text, unit))
    return F.coalesce(*tries)


def iso_ts(c: Column) -> Column:
    return F.try_to_timestamp(c)


def date_parts(c: Column, prefix: str) -> list[Column]:
    return [
        F.year(c).alias(f"{prefix}_year"),
        F.month(c).alias(f"{prefix}_month"),
        F.dayofmonth(c).alias(f"{prefix}_day"),
    ]


def elapsed_seconds(start: Column, end: Column) -> Column:
    return F.unix_timestamp(end) - F.unix_timestamp(start)


def elapsed_days(start: Column, end: Column) -> Column:
    """Fractional days."""
    return elapsed_seconds(start, end) / F.lit(86400.0)


def age_seconds(newest: Column, now: Column) -> Column:
    return elapsed_seconds(newest, now)


def unparsed(df: DataFrame, raw: str, parsed: str) -> DataFrame:
    """D4. Rows whose text is present and did not parse."""
    return df.filter(F.col(raw).isNotNull() & F.col(parsed).isNull())
