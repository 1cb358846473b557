"""Exact quantiles by radix selection (M4, A10).

`percentile` keeps every distinct value of the column in one aggregation buffer, which does not
survive a large table. Selection needs only counts: values are taken as 64-bit integers that keep
their order and counted once (combined map-side, one exchange that all rounds read); each round then sums the
counts by the next group of bits and keeps the one bucket that holds the wanted rank. A round
yields at most 2**MAX_BITS buckets per surviving prefix, so no task ever holds the column, a
frequent value is one row, and the source is read once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MAX_BITS = 16
WIDTH = 64
_FRACTION = 1 << 52
_INFINITE, _NAN = 0x7FF << 52, 0x7FF8 << 48


def _ordered_bits(column: Column) -> Column:
    """The bits of a double as an integer in the same order; negative values are mirrored.

    |x| = m * 2**e with 1 <= m < 2 (below the least normal number e stays -1022); all steps scale by powers of two
    and are exact. NaN is above everything, as Spark orders it; -0.0 is 0.
    """
    x = column.cast("double")
    size = F.abs(x)
    guess = F.greatest(F.least(F.floor(F.log2(size)), F.lit(1023)), F.lit(-1022)).cast("double")
    near = size / F.pow(F.lit(2.0), guess)  # the logarithm may be rounded across a power of two
    e = F.when(near >= 2, guess + 1).when((near < 1) & (guess > -1022), guess - 1).otherwise(guess)
    bits = ((e + 1022) * float(_FRACTION)).cast("bigint") + (size / F.pow(F.lit(2.0), e) * float(_FRACTION)).cast("bigint")
    bits = F.when(F.isnan(x), F.lit(_NAN)).when(size == float("inf"), F.lit(_INFINITE)).when(size == 0, F.lit(0).cast("bigint")).otherwise(bits)
    return F.when(x < 0, -bits).otherwise(bits)


def _double_of(bits: Column) -> Column:
    """The double that `_ordered_bits` made the integer of."""
    size = F.abs(bits)
    e, fraction = F.shiftright(size, 52).cast("double"), size.bitwiseAND(F.lit(_FRACTION - 1)).cast("double")
    value = (
        F.when(size > _INFINITE, F.lit(float("nan"))).when(size == _INFINITE, F.lit(float("inf")))
        .when(e == 0, fraction * F.pow(F.lit(2.0), F.lit(-1074.0)))
        .otherwise((1 + fraction / float(_FRACTION)) * F.pow(F.lit(2.0), e - 1023))
    )
    return F.when(bits < 0, -value).otherwise(value)


def _select_bucket(counts: DataFrame, within: list[str], targets: Column) -> DataFrame:
    """Keep the buckets that hold a wanted rank; their ranks are restated inside the bucket."""
    running = Window.partitionBy(*within).orderBy("_bucket")
    edges = counts.withColumn("_targets", targets).withColumn("_upto", F.sum("_n").over(running))
    below = F.col("_upto") - F.col("_n")
    inside = F.filter(
        "_targets", lambda t: (t["rank"] >= below) & (t["rank"] < F.col("_upto"))
    )
    restated = F.transform(inside, lambda t: t.withField("rank", t["rank"] - below))
    return edges.withColumn("_targets", restated).filter(F.size("_targets") > 0).drop("_n", "_upto")


def exact_quantiles(
    df: DataFrame,
    column: str,
    probabilities: Sequence[float],
    by: Sequence[str] = (),
) -> DataFrame:
    """One row per group (one row in all without `by`) with array `quantiles` of doubles.

    Linear interpolation between neighbours, NULLs ignored, NaN above all numbers. The values are those of the wanted ranks
    as doubles: exact for floating-point columns and integers up to 2**53, the nearest double of longer ones and of decimals.
    """
    units = _ordered_bits(F.col(column))
    # Groups are matched as one struct, so that a NULL group meets itself.
    group = F.struct(*[F.col(g) for g in by]) if by else F.lit(0)
    values = (
        df.filter(F.col(column).isNotNull()).select(group.alias("_group"), units.alias("_units"))
        .groupBy("_group", F.col("_units").alias("_key"))
        # The value is also returned as an aggregate: filters on a grouping key would be pushed
        # below the exchange, and each round would then need an exchange of its own.
        .agg(F.count(F.lit(1)).alias("_copies"), F.max("_units").alias("_units"))
        .drop("_key")
    )

    bits, rounds = MAX_BITS, WIDTH // MAX_BITS
    shifts = [bits * r for r in reversed(range(rounds))]
    low_bits = F.lit((1 << bits) - 1).cast("bigint")

    counts = values.groupBy("_group", F.shiftright("_units", shifts[0]).alias("_bucket")).agg(
        F.sum("_copies").alias("_n")
    )
    counts = counts.withColumn("_size", F.sum("_n").over(Window.partitionBy("_group")))
    targets = []
    for probe, p in enumerate(probabilities):
        position = (F.col("_size") - 1) * F.lit(float(p))
        for rank in (F.floor(position), F.ceil(position)):
            targets.append(F.struct(
                F.lit(probe).alias("probe"), (position - F.floor(position)).alias("weight"), rank.alias("rank")
            ))
    found = _select_bucket(counts, ["_group"], F.array(*targets)).select(
        "_group", F.col("_bucket").alias("_prefix"), "_targets"
    )
    for earlier, shift in zip(shifts, shifts[1:]):
        prefixed = values.withColumn("_prefix", F.shiftright("_units", earlier))
        if by:
            narrowed = prefixed.join(found, ["_group", "_prefix"])
        else:  # at most two prefixes per probability
            narrowed = prefixed.join(F.broadcast(found), ["_group", "_prefix"])
        digit = F.shiftright("_units", shift).bitwiseAND(low_bits)
        # The targets follow from the prefix; as a grouping key they ride along.
        counts = narrowed.groupBy("_group", "_prefix", "_targets", digit.alias("_bucket")).agg(
            F.sum("_copies").alias("_n")
        )
        found = _select_bucket(counts, ["_group", "_prefix"], F.col("_targets")).select(
            "_group", F.shiftleft("_prefix", bits).bitwiseOR(F.col("_bucket")).alias("_prefix"), "_targets"
        )
    low, high = F.min("_value"), F.max("_value")
    return (
        found.select(
            "_group",
            _double_of(F.col("_prefix")).alias("_value"),
            F.inline("_targets"),
        )
        .groupBy("_group", "probe")
        .agg(F.when(low == high, low).otherwise(low + (high - low) * F.max("weight")).alias("_q"))
        .groupBy("_group")
        .agg(F.array_sort(F.collect_list(F.struct("probe", "_q"))).alias("_all"))
        .select(
            *[F.col("_group")[g].alias(g) for g in by],
            F.transform("_all", lambda s: s["_q"]).alias("quantiles"),
        )
    )


def approx_quantiles(
    df: DataFrame, column: str, probabilities: Sequence[float], by: Sequence[str] = (), accuracy: int = 10000
) -> DataFrame:
    """Same shape from a bounded sketch: one pass, rank error at most 1/accuracy."""
    sketch = F.percentile_approx(F.col(column).cast("double"), list(probabilities), accuracy)
    return df.groupBy(*by).agg(sketch.alias("quantiles"))


def quantiles(
    df: DataFrame, column: str, probabilities: Sequence[float], by: Sequence[str] = (),
    accuracy: int | None = None,
) -> DataFrame:
    """Exact, or with `accuracy` from a sketch."""
    if accuracy is None:
        return exact_quantiles(df, column, probabilities, by)
    return approx_quantiles(df, column, probabilities, by, accuracy)


def _bounds(df: DataFrame, column: str, k: float, accuracy: int | None) -> DataFrame:
    q = quantiles(df, column, [0.25, 0.75], accuracy=accuracy)
    spread = F.col("quantiles")[1] - F.col("quantiles")[0]
    return q.select(
        F.col("quantiles")[0].alias("q1"),
        F.col("quantiles")[1].alias("q3"),
        spread.alias("iqr"),
        (F.col("quantiles")[0] - k * spread).alias("low"),
        (F.col("quantiles")[1] + k * spread).alias("high"),
    )


def iqr_bounds(
    df: DataFrame, column: str, k: float = 1.5, *, accuracy: int | None = None
) -> DataFrame:
    """One row: q1, q3, iqr, low, high."""
    return _bounds(df, column, k, accuracy)


def flag_outliers(
    df: DataFrame, column: str, k: float = 1.5, into: str = "is_outlier", *,
    accuracy: int | None = None,
) -> DataFrame:
    """Flag values outside the bounds; NULLs are not outliers.

    The bounds enter as a one-row scalar subquery, so nothing is collected and nothing is joined.
    """
    fence = _bounds(df, column, k, accuracy).select(F.struct("low", "high")).scalar()
    value = F.col(column).cast("double")
    outside = (value < fence.getField("low")) | (value > fence.getField("high"))
    return df.withColumn(into, F.coalesce(outside, F.lit(False)))


def drop_outliers(df: DataFrame, column: str, k: float = 1.5, **options) -> DataFrame:
    """Rows inside the bounds, and rows without a value."""
    return flag_outliers(df, column, k, "_outside", **options).filter(~F.col("_outside")).drop("_outside")
