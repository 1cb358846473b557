"""Quantile sketches that are kept by day and merged (A10, M4).

A KLL sketch of `k` holds some thousands of numbers whatever it was made of. One is made for each landing day and stored; bounds over all
history come from the merged sketches, so a new day costs a pass over that day alone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.sources.versions import VersionedTable

K = 800


def rank_error(k: int = K) -> float:
    """How far the rank of a merged quantile may be off, as a share of all values, with 99% confidence."""
    return 2.296 / k ** 0.9723


def day_sketches(df: DataFrame, column: str, day: str, k: int = K) -> DataFrame:
    """(day, sketch, n): one sketch for each day; NULLs and NaN are not values. Combined map-side, so a day may hold any share of the rows."""
    value = F.col(column).cast("double")
    usable = df.filter(value.isNotNull() & ~F.isnan(value))
    return usable.groupBy(F.col(day).alias("day")).agg(F.kll_sketch_agg_double(value, k).alias("sketch"), F.count(F.lit(1)).alias("n"))


def update_sketches(table: VersionedTable, df: DataFrame, column: str, day: str, since: object = None, k: int = K) -> int:
    """A new version of the stored sketches: those of the days from `since` on are made anew from `df`, which need hold no other days.

    Without `since` all are. A repeated run leaves the same. The new version's number is returned.
    """
    fresh = day_sketches(df if since is None else df.filter(F.col(day) >= F.lit(since)), column, day, k)
    if since is not None and table.manifest() is not None:
        fresh = table.read().filter(F.col("day") < F.lit(since)).unionByName(fresh)
    return table.overwrite(fresh)


def merged_quantiles(sketches: DataFrame, probabilities: Sequence[float], by: Sequence[str] = (), k: int = K) -> DataFrame:
    """One row (for each group) with `quantiles`, in the order of the probabilities, and `n`; no quantiles where there is no value."""
    merged = sketches.groupBy(*by).agg(F.kll_merge_agg_double("sketch", k).alias("_all"), F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
    found = F.array(*[F.kll_sketch_get_quantile_double("_all", F.lit(float(p))) for p in probabilities])
    return merged.select(*by, F.when(F.col("n") > 0, found).alias("quantiles"), "n")


def merged_iqr_bounds(sketches: DataFrame, k: float = 1.5, by: Sequence[str] = ()) -> DataFrame:
    """q1, q3, iqr, low, high as `iqr_bounds` has them, from stored sketches."""
    q1, q3 = F.col("quantiles")[0], F.col("quantiles")[1]
    return merged_quantiles(sketches, [0.25, 0.75], by).select(
        *by, q1.alias("q1"), q3.alias("q3"), (q3 - q1).alias("iqr"), (q1 - k * (q3 - q1)).alias("low"), (q3 + k * (q3 - q1)).alias("high"))
