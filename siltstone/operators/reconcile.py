"""Two tables compared by content (A4): which rows are missing, extra or changed.

Counts alone can agree by accident. Both sides are summed up by a hash of their keys into a tree of two levels: 2**`bits` branches, each
with the number of its rows and an order-free checksum, and as many again below each branch that differs. Only rows below
branches that differ on both levels are compared by key; where the tables are equal, nothing but the sums is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 10
MISSING, EXTRA, CHANGED = "missing", "extra", "changed"


def _sums(rows: DataFrame, level: str) -> DataFrame:
    return rows.groupBy(level).agg(
        F.count(F.lit(1)).alias("_n"), F.sum(F.col("_print").cast("decimal(20,0)")).alias("_sum"))


def _differing(left: DataFrame, right: DataFrame, level: str) -> DataFrame:
    """Branches whose rows aren't the same on both sides."""
    both = _sums(left, level).select(level, "_n", "_sum", F.lit(1).alias("_side")).unionByName(
        _sums(right, level).select(level, "_n", "_sum", F.lit(-1).alias("_side")))
    balance = both.groupBy(level).agg(F.sum(F.col("_n") * F.col("_side")).alias("_rows"), F.sum(F.col("_sum") * F.col("_side")).alias("_prints"))
    return balance.filter((F.col("_rows") != 0) | (F.col("_prints") != 0)).select(level)


def _by_key(rows: DataFrame, key: Sequence[str], others: Sequence[str], side: str) -> DataFrame:
    """One row for each key: its rows, their checksum, and the values of one of them."""
    named = F.struct(*[F.col(k) for k in key])  # a struct key matches on NULL
    return rows.groupBy(named.alias("_key")).agg(
        F.count(F.lit(1)).alias(f"_n_{side}"), F.sum(F.col("_print").cast("decimal(20,0)")).alias(f"_sum_{side}"),
        F.min(F.struct(*[F.col(c) for c in others] or [F.lit(0)])).alias(f"_row_{side}"))


def reconcile_rows(source: DataFrame, copy: DataFrame, key: Sequence[str], bits: int = BITS) -> DataFrame:
    """(key columns, state, source_rows, copy_rows, columns) of each key whose rows differ between the tables.

    `missing` keys are in `source` alone, `extra` ones in `copy` alone; of `changed` ones `columns` names what differs, where both sides
    have one row, else it is NULL and the row counts or some of several rows differ. The columns of `source` are compared,
    as 64-bit hashes of whole rows; `copy` must have them, with the same types. NULLs are values, also in keys.
    """
    others = [c for c in source.columns if c not in key]
    hashed = F.xxhash64(*key)
    place = {"_branch": F.shiftrightunsigned(hashed, 64 - bits), "_twig": F.shiftrightunsigned(hashed, 64 - 2 * bits),
             "_print": F.xxhash64(*[x for c in source.columns for x in (F.col(c), F.col(c).isNull())])}
    left, right = source.withColumns(place), copy.select(*source.columns).withColumns(place)
    branches = _differing(left, right, "_branch")
    left, right = (side.join(branches, "_branch", "left_semi") for side in (left, right))
    twigs = _differing(left, right, "_twig")
    left, right = (side.join(twigs, "_twig", "left_semi") for side in (left, right))
    both = _by_key(left, key, others, "l").join(_by_key(right, key, others, "r"), "_key", "full")
    unequal = [F.when(~F.col("_row_l")[c].eqNullSafe(F.col("_row_r")[c]), F.lit(c)) for c in others]
    names: Column = F.filter(F.array(*unequal), lambda c: c.isNotNull()) if unequal else F.array().cast("array<string>")
    state = F.when(F.col("_n_r").isNull(), MISSING).when(F.col("_n_l").isNull(), EXTRA).otherwise(CHANGED)
    same = F.col("_n_l").eqNullSafe(F.col("_n_r")) & F.col("_sum_l").eqNullSafe(F.col("_sum_r"))
    return both.filter(~same).select(
        *[F.col("_key")[k].alias(k) for k in key], state.alias("state"),
        F.coalesce("_n_l", F.lit(0)).cast("bigint").alias("source_rows"), F.coalesce("_n_r", F.lit(0)).cast("bigint").alias("copy_rows"),
        F.when((F.col("_n_l") == 1) & (F.col("_n_r") == 1), names).alias("columns"))
