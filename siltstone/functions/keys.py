"""Deterministic keys (K1)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def surrogate_key(system: str, source_id: Column) -> Column:
    """`md5("<system>:<id>")`: equal on every run and distinct between systems.

    A foreign reference must use the prefix of the system that owns the id, so that both sides of
    the join carry the same key.
    """
    return F.md5(F.concat(F.lit(f"{system}:"), source_id.cast("string")))
