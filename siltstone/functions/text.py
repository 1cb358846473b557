"""Text repair (M1 core, T1-T9, P8)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from siltstone import vocab


def blank_to_null(c: Column, words: Sequence[str] = vocab.PLACEHOLDERS, *, trim: bool = True) -> Column:
    """NULL where the text is one of the "no value" words. The value itself is not trimmed."""
    text = c.cast("string")
    probe = F.trim(text) if trim else text
    return F.when(~probe.isin(*words), c)


def strip_control(c: Column) -> Column:
    """Remove tabs and line breaks, then outer blanks."""
    return F.trim(F.translate(c, "\t\n\r", ""))


def lower_trim(c: Column) -> Column:
    return F.lower(F.trim(c))


def upper_trim(c: Column) -> Column:
    return F.upper(F.trim(c))


def title_trim(c: Column) -> Column:
    return F.initcap(F.trim(c))


def snake_category(c: Column) -> Column:
    """`Credit  Card`, `credit_card` and `CREDIT CARD` all become `credit_card`."""
    return F.regexp_replace(lower_trim(c), r"[\s_]+", "_")


def sku_simple(c: Column) -> Column:
    """Upper-case code with `-` in place of blanks and underscores."""
    return F.regexp_replace(upper_trim(c), r"[\s_]", "-")


def sku_canonical(c: Column) -> Column:
    """Struct `(canonical, changed)`: one `SKU-XXXX` spelling for every regional variant.

    An empty code gives `('', false)`; a code with no usable characters is returned untouched.
    """
    body = F.regexp_replace(upper_trim(c), r"^SKU[-_]?", "")
    body = F.regexp_replace(body, r"-[A-Z]{2,3}$", "")
    body = F.regexp_replace(body, r"[^A-Z0-9]", "")
    spelled = F.concat(F.lit("SKU-"), body)
    missing = c.isNull() | (c == "")
    canonical = F.when(missing, "").when(body == "", c).otherwise(spelled)
    changed = F.when(missing | (body == ""), False).otherwise(spelled != F.upper(c))
    return F.struct(canonical.alias("canonical"), changed.alias("changed"))


def phone_truncate(c: Column, length: int = vocab.MAX_PHONE_LENGTH) -> Column:
    return F.substring(c, 1, length)


def enum_or_null(c: Column, valid: Sequence[str]) -> Column:
    """Upper-cased member of `valid`, otherwise NULL."""
    word = upper_trim(c)
    return F.when(word.isin(*valid), word)


def fix_typos(c: Column, mapping: Mapping[str, str] = vocab.STATUS_TYPOS) -> Column:
    """Known misspellings replaced; other words only lower-cased and trimmed.

    The mapping is a literal of the plan, so there is no lookup table to join or broadcast.
    """
    word = lower_trim(c)
    lookup = F.create_map(*[F.lit(part) for pair in mapping.items() for part in pair])
    return F.coalesce(F.try_element_at(lookup, word), word)


def nearest_word(c: Column, valid: Sequence[str], max_distance: int = 2) -> Column:
    """Closest word of `valid` by edit distance, NULL beyond `max_distance`.

    Ties go to the word listed first. One expression per candidate: no join, no pairs.
    """
    word = lower_trim(c)
    ranked = [
        F.struct(
            F.levenshtein(word, F.lit(v)).alias("distance"),
            F.lit(position).alias("position"),
            F.lit(v).alias("word"),
        )
        for position, v in enumerate(valid)
    ]
    best = F.least(*ranked) if len(ranked) > 1 else ranked[0]
    return F.when(word.isNotNull() & (best["distance"] <= max_distance), best["word"])


def is_email(c: Column) -> Column:
    return F.rlike(lower_trim(c), F.lit(r"^[^@\s]+@[^@\s]+\.[^@\s]+$"))


def looks_truncated(c: Column) -> Column:
    return F.endswith(c, F.lit("..."))


def has_doubled_vowel(c: Column) -> Column:
    return F.rlike(c, F.lit(r"(?i)([aeiou])\1"))


def is_shouting(c: Column) -> Column:
    """All capitals (and containing at least one letter)."""
    return (c == F.upper(c)) & (F.lower(c) != F.upper(c))


def has_hidden_space(c: Column) -> Column:
    return c != strip_control(c)
