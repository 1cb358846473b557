"""Versions of rows over time, and facts joined to the version of their time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def validity(changes: DataFrame, key: str, at: str, ties: Sequence[str] = (), deleted: str | None = None) -> DataFrame:
    """The columns of `changes`, then valid_from, valid_to and is_current: one row for each state that a key was in.

    A state holds from its change until the key's next one, `valid_to`, which is NULL for the one that still holds. Of changes at one time, in
    the order of `ties`, the last holds; the others never did and are left out. Rows for which the condition `deleted` is true end
    a state and begin none. Changes without a key or a time are left out.
    """
    gone = F.coalesce(F.expr(deleted), F.lit(False)) if deleted else F.lit(False)
    known = changes.filter(F.col(key).isNotNull() & F.col(at).isNotNull()).withColumn("_gone", gone)
    order = Window.partitionBy(key).orderBy(F.col(at), *[F.col(t).asc_nulls_first() for t in ties])
    states = known.withColumn("valid_to", F.lead(at).over(order)).withColumn("valid_from", F.col(at))
    held = states.filter(~F.col("_gone") & (F.col("valid_to").isNull() | (F.col("valid_to") > F.col("valid_from"))))
    return held.select(*changes.columns, "valid_from", "valid_to", F.col("valid_to").isNull().alias("is_current"))


def as_of(
    facts: DataFrame, versions: DataFrame, key: str, fact_at: str, valid_from: str = "valid_from", valid_to: str | None = "valid_to",
    *, chunk: str = "MONTH",
) -> DataFrame:
    """`facts` with the columns of the version that held at their time, NULL where none did.

    Facts and versions are sorted together by key and time, and each fact takes the last version before it, or at its own time: no range
    join, no pairs. A key's time is cut into chunks that are sorted apart; the last version of a chunk is handed to those after it, so a
    key may have any share of the facts. With `valid_to`, a version that had ended by then is none. Facts without a key or a time have no
    version. Columns of `versions` other than the key must not occur in `facts`; one version begins at a time.
    """
    own = [c for c in versions.columns if c != key]
    if clash := set(own) & set(facts.columns):
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    told = F.struct(*[F.col(c) for c in own])
    row = F.struct(*[F.col(c) for c in facts.columns])
    none_fact, none_version = F.lit(None).cast(facts.select(row.alias("r")).schema["r"].dataType), F.lit(None).cast(versions.select(told.alias("v")).schema["v"].dataType)
    both = facts.select(F.col(key).alias("_key"), F.col(fact_at).alias("_at"), F.lit(1).alias("_kind"), row.alias("_fact"), none_version.alias("_version")).unionByName(
        versions.filter(F.col(key).isNotNull() & F.col(valid_from).isNotNull()).select(
            F.col(key).alias("_key"), F.col(valid_from).alias("_at"), F.lit(0).alias("_kind"), none_fact.alias("_fact"), told.alias("_version")))
    both = both.withColumn("_chunk", F.date_trunc(chunk, F.col("_at").cast("timestamp")))
    inside = Window.partitionBy("_key", "_chunk").orderBy("_at", "_kind")
    met = both.withColumn("_seen", F.last("_version", ignorenulls=True).over(inside))
    # The last version of each chunk that has any, handed on.
    ends = both.filter("_kind = 0").groupBy("_key", "_chunk").agg(F.max_by("_version", "_at").alias("_last"))
    places = both.filter("_kind = 1").select("_key", "_chunk").distinct().withColumn("_last", none_version).unionByName(ends)
    places = places.groupBy("_key", "_chunk").agg(F.max("_last").alias("_last"))
    before = Window.partitionBy("_key").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = places.withColumn("_carried", F.last("_last", ignorenulls=True).over(before)).select(
        F.col("_key").alias("_its_key"), F.col("_chunk").alias("_its_chunk"), "_carried")
    same = (F.col("_key") == F.col("_its_key")) & (F.col("_chunk") == F.col("_its_chunk"))
    found = met.filter("_kind = 1").join(carried, same, "left").withColumn("_found", F.coalesce("_seen", "_carried"))
    usable = F.col("_key").isNotNull() & F.col("_at").isNotNull()
    if valid_to:
        usable = usable & (F.col("_found")[valid_to].isNull() | (F.col("_found")[valid_to] > F.col("_at")))
    return found.select(*[F.col("_fact")[c].alias(c) for c in facts.columns], *[F.when(usable, F.col("_found")[c]).alias(c) for c in own])
