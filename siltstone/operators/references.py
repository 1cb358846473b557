"""Referential checks and gap reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone import vocab
from siltstone.operators.skew import skew_join


def _parents(parent: DataFrame, parent_key: str, as_name: str) -> DataFrame:
    return parent.select(F.col(parent_key).alias(as_name)).dropna().distinct()


def orphans(child: DataFrame, fk: str, parent: DataFrame, parent_key: str = "id") -> DataFrame:
    """J3. Rows whose reference points nowhere. Rows without a reference are not orphans."""
    refs = child.filter(F.col(fk).isNotNull())
    return skew_join(refs, _parents(parent, parent_key, fk), [fk], "left_anti")


def keep_referenced(child: DataFrame, fk: str, parent: DataFrame, parent_key: str = "id") -> DataFrame:
    """J4. Rows whose parent exists."""
    refs = child.filter(F.col(fk).isNotNull())
    return skew_join(refs, _parents(parent, parent_key, fk), [fk], "left_semi")


def _edge(tables: Mapping[str, DataFrame], child: str, fk: str, parent: str, parent_key: str) -> DataFrame:
    # Counting rows per reference first (combined map-side) leaves one row per reference value:
    # the join then sees no skew and moves no child rows.
    refs = tables[child].groupBy(F.col(fk).alias("_ref")).agg(F.count(F.lit(1)).alias("_n"))
    known = _parents(tables[parent], parent_key, "_ref").withColumn("_known", F.lit(True))
    judged = refs.join(known, "_ref", "left")
    lost = F.col("_ref").isNotNull() & F.col("_known").isNull()
    return judged.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("child_rows"),
        F.coalesce(F.sum(F.when(F.col("_ref").isNull(), F.col("_n"))), F.lit(0)).alias("null_refs"),
        F.coalesce(F.sum(F.when(lost, F.col("_n"))), F.lit(0)).alias("orphans"),
    ).select(
        F.lit(child).alias("child_table"), F.lit(fk).alias("fk"), F.lit(parent).alias("parent_table"),
        "child_rows", "null_refs", "orphans",
    )


def fk_report(
    tables: Mapping[str, DataFrame],
    edges: Sequence[tuple] = vocab.FOREIGN_KEYS,
) -> DataFrame:
    """J5. One row per reference edge: rows, missing references, orphans.

    An edge is (child, fk, parent) or (child, fk, parent, parent_key); the key is `id` otherwise.
    Edges whose tables are not given are left out.
    """
    wanted = [(*e, "id")[:4] for e in edges if e[0] in tables and e[2] in tables]
    return reduce(DataFrame.unionByName, [_edge(tables, *e) for e in wanted])


def without_match(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of `df` (one per key) with no row in `other`; `other` is reduced to its keys first."""
    return df.join(other.select(*keys).dropna().distinct(), list(keys), "left_anti")


def with_match(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.join(other.select(*keys).dropna().distinct(), list(keys), "left_semi")


def unpaid_orders(orders: DataFrame, payments: DataFrame, order_id: str = "order_id", status: str = "status") -> DataFrame:
    """J8. Orders without any payment that are not cancelled; an unknown status is not a cancellation."""
    open_orders = orders.filter(~F.lower(status).eqNullSafe("cancelled"))
    return without_match(open_orders, payments, [order_id])


def unshipped_paid_orders(
    orders: DataFrame, payments: DataFrame, shipments: DataFrame, order_id: str = "order_id",
    status: str = "status", payment_status: str = "payment_status",
) -> DataFrame:
    """J9. Paid orders, neither cancelled nor returned, without a shipment."""
    active = orders.filter(~F.coalesce(F.lower(status).isin("cancelled", "returned"), F.lit(False)))
    paid = payments.filter(F.lower(payment_status) == "completed")
    return without_match(with_match(active, paid, [order_id]), shipments, [order_id])


def unreviewed_items(
    orders: DataFrame, items: DataFrame, reviews: DataFrame,
    order_id: str = "order_id", product_id: str = "product_id", status: str = "status",
) -> DataFrame:
    """J10. Distinct (order, product) pairs of delivered orders without a review."""
    delivered = orders.filter(F.lower(status) == "delivered").select(order_id)
    pairs = items.select(order_id, product_id).dropna().distinct()
    # One order may hold many of the pairs; Spark splits such a partition at run time.
    return without_match(skew_join(pairs, delivered, [order_id], "left_semi"), reviews, [order_id, product_id])


def orders_without_items(orders: DataFrame, items: DataFrame, order_id: str = "order_id") -> DataFrame:
    """J11."""
    return without_match(orders, items, [order_id])


def amount_mismatch(
    orders: DataFrame, order_id: str, expected: str,
    payments: DataFrame, payment_order_id: str, paid: str,
    tolerance: float = 0.01, kind: str = "decimal(12,2)",
) -> DataFrame:
    """J12. Orders whose summed payments differ from the expected amount, with signed deltas, and orders with payments
    that have no readable amount (`unreadable` tells how many; they count as nothing)."""
    amount = F.col(paid).try_cast(kind)
    sums = payments.groupBy(F.col(payment_order_id).alias(order_id)).agg(
        F.coalesce(F.sum(amount), F.lit(0).cast(kind)).alias("_paid"),
        F.count_if(F.col(paid).isNotNull() & amount.isNull()).alias("unreadable"),
    )
    both = orders.select(order_id, F.col(expected).try_cast(kind).alias("_due")).join(sums, order_id, "inner")
    delta = F.col("_paid") - F.col("_due")
    off = F.coalesce(F.abs(delta) > F.lit(tolerance).cast("decimal(12,4)"), F.lit(False))
    relative: Column = F.when(F.col("_due") != 0, delta.cast("double") / F.col("_due").cast("double"))
    return both.filter(off | (F.col("unreadable") > 0)).select(
        order_id,
        F.col("_due").cast("double").alias("expected_amount"),
        F.col("_paid").cast("double").alias("paid_amount"),
        delta.cast("double").alias("delta"),
        relative.alias("relative_delta"),
        "unreadable",
    )


def classify_late_arrivals(
    payments: DataFrame, orders: DataFrame, order_id: str = "order_id",
    paid_at: str = "paid_at", ordered_at: str = "ordered_at", minutes: int = vocab.LATE_MINUTES,
) -> DataFrame:
    """J6. Every payment with `_join_result`: joined, late (too far apart) or waiting (no order).

    `orders` has one row per order. Adds `_join_lag_sec` (positive: payment after order, with its fraction) and, for
    late rows, `_dlq_reason` worded by the sign of the lag.
    """
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    lag = (micros(paid_at) - micros(ordered_at)) / F.lit(1e6)
    matched = skew_join(payments, orders.withColumn("_found", F.lit(True)), [order_id], "left")
    in_time = F.abs(F.col("_join_lag_sec")) <= minutes * 60
    side = F.when(F.col("_join_lag_sec") < 0, "before").otherwise("after")
    return (
        matched.withColumn("_join_lag_sec", lag)
        .withColumn(
            "_join_result",
            F.when(F.col("_found").isNull(), "waiting")
            .when(F.coalesce(in_time, F.lit(False)), "joined")
            .otherwise("late"),
        )
        .withColumn(
            "_dlq_reason",
            F.when(
                F.col("_join_result") == "late",
                F.concat(
                    F.lit("payment "), F.abs(F.col("_join_lag_sec")).cast("decimal(20,3)").cast("string"), F.lit("s "), side,
                    F.lit(f" its order, allowed {minutes} min"),
                ),
            ),
        )
        .drop("_found")
    )
