"""Counts, reconciliation and health."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from siltstone import vocab
from siltstone.functions.times import age_seconds


def newest_rows(df: DataFrame, order: Sequence[str], n: int = 3) -> DataFrame:
    """S17. The n newest rows; every task forwards only its own n."""
    return df.orderBy(*[F.col(c).desc_nulls_last() for c in order]).limit(n)


def monthly_revenue(fact: DataFrame) -> DataFrame:
    """A1. Items and revenue by month. Sums run on decimals, the result is a double."""
    return (
        fact.groupBy("order_year", "order_month")
        .agg(
            F.count(F.lit(1)).alias("total_items"),
            F.sum("item_total").cast("double").alias("total_revenue"),
        )
        .orderBy("order_year", "order_month")
    )


def top_brands(fact: DataFrame, n: int = 5) -> DataFrame:
    """A2. Best brands by revenue; equal revenue is settled by name."""
    return (
        fact.filter(F.col("brand").isNotNull())
        .groupBy("brand")
        .agg(F.count(F.lit(1)).alias("items_sold"), F.sum("item_total").cast("double").alias("revenue"))
        .orderBy(F.desc("revenue"), "brand")
        .limit(n)
    )


def layer_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """A3 / S13. One row per table. Parquet answers from file footers, no column is read."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def reconcile(pairs: Sequence[tuple[str, DataFrame, DataFrame, str]]) -> DataFrame:
    """A4. `(check, left_rows, right_rows, ratio, status)` for pairs (check, left, right, expect).

    `expect` compares left with right: `at_most`, `at_least` or `equal`; otherwise WARN.
    """
    holds = {
        "at_most": F.col("left_rows") <= F.col("right_rows"),
        "at_least": F.col("left_rows") >= F.col("right_rows"),
        "equal": F.col("left_rows") == F.col("right_rows"),
    }
    rows = []
    for check, left, right, expect in pairs:
        right_rows = right.agg(F.count(F.lit(1)).alias("n")).scalar()
        rows.append(
            left.agg(F.count(F.lit(1)).alias("left_rows"))
            .withColumn("right_rows", right_rows)
            .select(
                F.lit(check).alias("check"), "left_rows", "right_rows",
                F.when(F.col("right_rows") > 0, F.col("left_rows") / F.col("right_rows")).alias("ratio"),
                F.when(holds[expect], "OK").otherwise("WARN").alias("status"),
            )
        )
    return reduce(DataFrame.unionByName, rows)


def freshness(
    df: DataFrame, ts: str, now: Column, fresh: int = vocab.FRESH_SECONDS, stale: int = vocab.STALE_SECONDS
) -> DataFrame:
    """A5. Age of the newest row and its verdict. `now` is an argument, so reports are repeatable."""
    age = F.col("age_seconds")
    return (
        df.agg(F.max(ts).alias("newest"))
        .withColumn("age_seconds", age_seconds(F.col("newest"), now))
        .withColumn("status", F.when(age < fresh, "OK").when(age < stale, "WARN").otherwise("FAIL"))
    )


def topic_stats(bronze: DataFrame, expected: Sequence[str] = vocab.EXPECTED_TOPICS) -> DataFrame:
    """A6. Messages per topic from the landed offsets; WARN where an expected topic is empty.

    Dead-letter topics may be empty.
    """
    seen = (
        bronze.groupBy("_source_topic", "_kafka_partition")
        .agg(F.count(F.lit(1)).alias("_rows"), F.max("_kafka_offset").alias("_end"))
        .select(F.col("_source_topic").alias("topic"), "_rows", (F.col("_end") + 1).alias("_log"), F.lit(1).alias("_part"))
    )
    zero = F.lit(0).cast("bigint")
    silent = bronze.sparkSession.createDataFrame([(t,) for t in expected], "topic string").select(
        "topic", zero.alias("_rows"), zero.alias("_log"), F.lit(0).alias("_part")
    )
    return (
        seen.unionByName(silent)
        .groupBy("topic")
        .agg(
            F.sum("_rows").alias("messages"),
            F.sum("_log").alias("end_offsets"),
            F.sum("_part").cast("bigint").alias("partitions"),
        )
        .withColumn(
            "status",
            F.when((F.col("messages") == 0) & ~F.endswith("topic", F.lit(".dlq")), "WARN").otherwise("OK"),
        )
    )


def quality_counts(tagged: Mapping[str, DataFrame]) -> DataFrame:
    """A7. Rows per (entity, route) over routed frames, with each route's share of its entity."""
    shaped = [df.select(F.lit(name).alias("entity"), F.col("_route").alias("route")) for name, df in tagged.items()]
    counts = reduce(DataFrame.unionByName, shaped).groupBy("entity", "route").agg(F.count(F.lit(1)).alias("row_count"))
    totals = counts.groupBy("entity").agg(F.sum("row_count").alias("_total"))
    return counts.join(totals, "entity").select(
        "entity", "route", "row_count", (F.col("row_count") / F.col("_total")).alias("share")
    )


def write_observed(frames: Mapping[str, DataFrame], folder: str, metrics: Mapping[str, Mapping[str, Column]]) -> dict[str, dict[str, object]]:
    """A7, D8, Q11 without a scan of their own: writes each frame below `folder`, split by `_route` where it has one, and returns the
    aggregates in `metrics` of its rows as the write itself has seen them."""
    seen = {}
    for name, df in frames.items():
        watch = Observation(f"{name}-{uuid.uuid4().hex}")
        split = ["_route"] if "_route" in df.columns else []
        df.observe(watch, *[c.alias(m) for m, c in metrics[name].items()]).write.partitionBy(*split).parquet(f"{folder}/{name}")
        seen[name] = watch.get
    return seen


def observed_quality_counts(tagged: Mapping[str, DataFrame], folder: str, routes: Sequence[str] = ("silver", "dead_letter", "quarantine")) -> DataFrame:
    """A7 as `quality_counts`, from the writes of the routed frames: each is read once, and written."""
    counts = {r: F.count_if(F.col("_route") == r) for r in routes}
    seen = write_observed(tagged, folder, {name: counts for name in tagged})
    rows = [(name, r, n[r], n[r] / sum(n.values())) for name, n in seen.items() for r in routes if n[r]]
    spark = next(iter(tagged.values())).sparkSession
    return spark.createDataFrame(rows, "entity string, route string, row_count bigint, share double")


def coupon_usage(coupons: DataFrame, orders: DataFrame, coupon_id: str = "coupon_id", coupon_key: str = "id") -> DataFrame:
    """A11. Uses per coupon counted from orders, and what is left of `max_uses`."""
    used = orders.groupBy(F.col(coupon_id).alias(coupon_key)).agg(F.count(F.lit(1)).alias("_used"))
    used_n = F.coalesce(F.col("_used"), F.lit(0))
    return coupons.join(used, coupon_key, "left").select(
        *coupons.columns, used_n.alias("times_used_actual"), (F.col("max_uses") - used_n).alias("remaining")
    )


def expire_coupons(coupons: DataFrame, now: Column, until: str = "valid_until", active: str = "is_active") -> DataFrame:
    """A12. Coupons past their last day are no longer active."""
    return coupons.withColumn(active, F.col(active) & ~F.coalesce(F.col(until) < now, F.lit(False)))


def health_verdict(checks: DataFrame, status: str = "status") -> DataFrame:
    """A13. One row: counts per status and the overall verdict."""
    return checks.agg(
        F.count_if(F.col(status) == "OK").alias("ok"),
        F.count_if(F.col(status) == "WARN").alias("warnings"),
        F.count_if(F.col(status) == "FAIL").alias("failures"),
    ).withColumn(
        "verdict",
        F.when(F.col("failures") > 0, "FAIL").when(F.col("warnings") > 0, "WARN").otherwise("OK"),
    )
