"""Keys and duplicates (K2-K8). Every survivor is chosen by a total order, so reruns agree."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from siltstone.functions.numbers import clean_number
from siltstone.functions.text import lower_trim
from siltstone.operators.skew import SALTS


def _first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    # `row_number = 1` lets Spark cut every map task down to one row per key before the shuffle,
    # so a key that holds a third of the table still reaches its task as a handful of rows.
    ranked = df.withColumn("_place", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col("_place") == 1).drop("_place")


def latest_per_key(df: DataFrame, keys: Sequence[str], newest: str, ties: Sequence[str] = ()) -> DataFrame:
    """K3. The newest row of each key, missing times last; `ties` settle equal times, highest first."""
    return _first(df, keys, [F.col(newest).desc_nulls_last(), *[F.col(t).desc_nulls_last() for t in ties]])


def earliest_per_key(df: DataFrame, keys: Sequence[str], oldest: str, ties: Sequence[str] = ()) -> DataFrame:
    """K3 ascending / K5 with an explicit order. Missing times last."""
    return _first(df, keys, [F.col(oldest).asc_nulls_last(), *[F.col(t).asc_nulls_last() for t in ties]])


def dedup_exact(df: DataFrame) -> DataFrame:
    """K2. Whole-row distinct (combined map-side)."""
    return df.dropDuplicates()


def duplicate_count(df: DataFrame) -> DataFrame:
    """K2. One row: total rows, distinct rows, and their difference."""
    per_row = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies"))
    return per_row.agg(
        F.coalesce(F.sum("_copies"), F.lit(0)).alias("total_rows"),
        F.count(F.lit(1)).alias("distinct_rows"),
        F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).alias("duplicate_rows"),
    )


def repeated_text(df: DataFrame, text: str, row_id: str) -> DataFrame:
    """K2 for long text: `(first_id, copies)` per text that occurs more than once.

    Rows are grouped by a SHA-256 digest of the whole text, so the shuffle carries 64 characters
    per distinct text and map task instead of the text.
    """
    return (
        df.groupBy(F.sha2(F.col(text), 256).alias("_digest"))
        .agg(F.min(row_id).alias("first_id"), F.count(F.lit(1)).alias("copies"))
        .filter(F.col("copies") > 1)
        .drop("_digest")
    )


def dedup_events(
    df: DataFrame, event_id: str = "_event_id", business_key: str = "transaction_id",
    seen_at: str = "_ingested_at", *, redelivered_as_is: bool = False,
) -> DataFrame:
    """K4. One event per business key: the earliest, after redeliveries of one event are dropped.

    An event id that reappears, under another business key too, is a redelivery: the earliest delivery of each event is taken
    first. An event without an id (NULL or empty) is no other event's redelivery. With `redelivered_as_is=True` the caller vouches that redeliveries are copies and share the business key; the
    earliest-per-key step then removes them too, with one shuffle less.
    """
    named = F.col(business_key).isNotNull() & (F.col(business_key) != "")
    known = df.filter(named)
    if not redelivered_as_is:
        # Without an id no two events are known to be one; they meet under their business key alone.
        rows = df.withColumn("_alone", F.when(F.coalesce(F.col(event_id).cast("string"), F.lit("")) == "", F.col(business_key)))
        known = earliest_per_key(rows, [event_id, "_alone"], seen_at, [business_key]).drop("_alone").filter(named)
    return earliest_per_key(known, [business_key], seen_at, [event_id])


def dedup_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """K5. One row per business key; the caller states which one."""
    return _first(df, keys, order)


def flag_repeats(df: DataFrame, keys: Sequence[str], order: Sequence[str], into: str = "is_repeat") -> DataFrame:
    """K6. True for every row but the first (by `order`, a total order) of its key.

    Of rows that are equal, one is the first. Numbering all rows of a key would sort a hot key in one task, so they are
    numbered by (key, salt) first; only the leaders of the salts, a few rows for each key, meet. Keys that are NULL form
    one group.
    """
    salt = F.pmod(F.xxhash64(*order), F.lit(SALTS))
    place = lambda *by: F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    rows = df.withColumn("_salt", salt).withColumn("_place", place(*keys, "_salt"))
    leaders = rows.filter(F.col("_place") == 1).withColumn(into, place(*keys) > 1)
    others = rows.filter(F.col("_place") > 1).withColumn(into, F.lit(True))
    return leaders.select(*df.columns, into).unionByName(others.select(*df.columns, into))


def key_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """K7. Keys that occur more than once, with their row count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter(F.col("copies") > 1)


def _twin_rows(
    df: DataFrame, exact: Sequence[str], text: Sequence[str], amount: str, tolerance: str,
) -> tuple[DataFrame, list[str], float, float]:
    """The rows with what near twins have in common beside them (and the names of these columns), the reach and the width of a band."""
    reach = float(tolerance) * (1 + 1e-6)
    folded = {f"_t{i}": F.struct(F.regexp_replace(lower_trim(F.col(t)), r"\s+", " ").alias("t")) for i, t in enumerate(text)}  # a struct key matches on NULL
    numeric = isinstance(df.schema[amount].dataType, NumericType)
    value = F.col(amount).cast("double") if numeric else clean_number(F.col(amount))
    return df.withColumns({**folded, "_amount": value}), [*exact, *folded], reach, max(reach, 1e-300) * 1000


def _bands(reach: float, band: float) -> tuple[Column, Column]:
    """The band of an amount, and all those that its reach touches."""
    home = F.floor(F.col("_amount") / band)
    return home, F.array_distinct(F.array(home, F.floor((F.col("_amount") - reach) / band), F.floor((F.col("_amount") + reach) / band)))


def _near(steps: DataFrame, group: Sequence[str], reach: float) -> DataFrame:
    """Steps in bands (with `_n` rows and the lowest id `_low`) with `near_rows` and `twin_id` of the amounts within `reach`."""
    near = f"OVER (PARTITION BY {', '.join(f'`{g}`' for g in group)}, _band ORDER BY _amount RANGE BETWEEN {reach!r}D PRECEDING AND {reach!r}D FOLLOWING)"
    return steps.withColumns({"near_rows": F.expr(f"sum(_n) {near}"), "twin_id": F.expr(f"min(_low) {near}")})


def _around(steps: DataFrame, group: Sequence[str], reach: float, band: float) -> DataFrame:
    """Steps (with `_n` rows and the lowest id `_low`) with `near_rows` and `twin_id` of the amounts within `reach`."""
    home, bands = _bands(reach, band)
    copied = steps.withColumn("_home", home).withColumn("_band", F.explode(bands))
    return _near(copied, group, reach).filter(F.col("_band").eqNullSafe(F.col("_home"))).drop("_home", "_band")


def near_duplicates(
    df: DataFrame, row_id: str, exact: Sequence[str], text: Sequence[str], amount: str, tolerance: str = "0.01",
) -> DataFrame:
    """K8. Rows with an earlier near twin: same `exact` columns, same folded text, amount within
    `tolerance`. Adds `twin_id` (smallest id of the neighbourhood) and `near_rows` (its size).

    `amount` may be a number or the text of one ("$10.00", "1,234.56"); rows without an amount, or with a NULL among
    the `exact` columns, have no twins. Amounts are compared as doubles, with a millionth of the tolerance to spare for what
    a double can't hold.

    No pairs are formed. Equal amounts are counted once; a range window then sums the counts around each amount. Its
    partitions are bands of a thousand tolerances, into which the amounts near a band's edge are copied.
    """
    rows, group, reach, band = _twin_rows(df, exact, text, amount, tolerance)
    rows = rows.dropna(subset=["_amount", *exact])
    steps = rows.groupBy(*group, "_amount").agg(F.count(F.lit(1)).alias("_n"), F.min(row_id).alias("_low"))
    around = _around(steps, group, reach, band).filter("near_rows > 1").select(*group, "_amount", "near_rows", "twin_id")
    return rows.join(around, [*group, "_amount"]).filter(F.col("twin_id") < F.col(row_id)).select(*df.columns, "twin_id", "near_rows")


def near_twin_sums(
    df: DataFrame, sums: Mapping[str, Column], row_id: str, exact: Sequence[str], text: Sequence[str], amount: str, tolerance: str = "0.01",
) -> DataFrame:
    """The sums of `near_duplicates` without its rows: `sums` of all rows in parts, with `_twins`, how many of a part's rows have an earlier near twin.

    `df` is read once, and only its ids, amounts, keys and what is summed are shuffled: once, by key and band, into all of the session's shuffle
    partitions. They aren't put together again by their size in bytes, of which a shuffle file says little: 64 MB of it took 2 GB in a task.
    Rows that can't have a twin are dealt out by their id.
    """
    rows, group, reach, band = _twin_rows(df, exact, text, amount, tolerance)
    rows = rows.select(*group, "_amount", F.col(row_id).alias("_id"), *[c.alias(k) for k, c in sums.items()])
    known = reduce(lambda a, c: a & F.col(c).isNotNull(), exact, F.col("_amount").isNotNull())
    home, bands = _bands(reach, band)
    dealt = F.pmod(F.xxhash64("_id"), F.lit(SALTS))
    copied = rows.withColumn("_home", F.when(known, home).otherwise(dealt)).withColumn(
        "_band", F.explode(F.when(known, bands).otherwise(F.array("_home"))))
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    copied = copied.repartition(parts, *group, "_band")
    step = [*group, "_band", "_home", "_amount"]
    by_id = copied.groupBy(*step, "_id").agg(F.count(F.lit(1)).alias("_rows"), *[F.sum(k).alias(k) for k in sums])
    # The rows with the lowest id have no earlier twin among their own step.
    steps = by_id.groupBy(*step).agg(
        F.coalesce(F.sum(F.when(F.col("_id").isNotNull(), F.col("_rows"))), F.lit(0)).alias("_named"), F.sum("_rows").alias("_n"),
        F.min("_id").alias("_low"), F.min_by("_rows", "_id").alias("_lowest"), *[F.sum(k).alias(k) for k in sums])
    around = _near(steps, group, reach).filter(F.col("_band").eqNullSafe(F.col("_home")))
    own = F.when(F.col("_low") == F.col("twin_id"), F.col("_lowest")).otherwise(0)
    twins = F.when(known & (F.col("near_rows") > 1), F.col("_named") - own).otherwise(0)
    return around.select(*sums, twins.cast("bigint").alias("_twins"))
