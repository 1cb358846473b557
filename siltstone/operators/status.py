"""State derived from events (Q7-Q10)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.operators.dedup import latest_per_key
from siltstone.operators.skew import previous_value, skew_join

PAYMENT_STAMPS = {"paid_at": "completed"}
SHIPPING_STAMPS = {"shipped_at": "picked_up", "delivered_at": "delivered"}


def fold_status(
    events: DataFrame, key: str, at: str, tie: str, status_to: str = "status_to",
    stamps: Mapping[str, str] = SHIPPING_STAMPS,
) -> DataFrame:
    """One row per key: `current_status`, `changed_at`, `changes`, and the first time of each
    stamped status. A plain aggregate, combined map-side. Events that carry no status change nothing and are not counted."""
    newest = F.struct(F.col(at), F.col(tie))
    return events.filter(F.col(status_to).isNotNull()).groupBy(key).agg(
        F.max_by(status_to, newest).alias("current_status"),
        F.max(at).alias("changed_at"),
        F.count(F.lit(1)).alias("changes"),
        *[F.min(F.when(F.col(status_to) == value, F.col(at))).alias(name) for name, value in stamps.items()],
    )


def apply_status_events(
    entity: DataFrame, events: DataFrame, key: str, at: str, tie: str, status: str = "status",
    status_to: str = "status_to", stamps: Mapping[str, str] = SHIPPING_STAMPS,
) -> DataFrame:
    """Q7. `entity` (one row per key) with its status moved forward and its times stamped.

    Entities without a key are kept as they are, however many there are.
    """
    fold = fold_status(events, key, at, tie, status_to, stamps)
    fold = fold.select(key, "current_status", *[F.col(s).alias(f"_{s}") for s in stamps])
    out = skew_join(entity, fold.dropna(subset=[key]), [key], "left")
    have = set(entity.columns)
    changed = {status: F.coalesce("current_status", F.col(status))}
    for name in stamps:
        changed[name] = F.coalesce(F.col(name), F.col(f"_{name}")) if name in have else F.col(f"_{name}")
    return out.withColumns(changed).drop("current_status", *[f"_{s}" for s in stamps])


def _is_step(before: Column, now: Column, allowed: Sequence[tuple[str, str]]) -> Column:
    return reduce(
        lambda a, step: a | ((before == step[0]) & (now == step[1])), allowed, F.lit(False)
    )


def illegal_transitions(
    events: DataFrame, keys: Sequence[str], status: str, at: str, tie: str,
    allowed: Sequence[tuple[str, str]], *, chunk: str = "HOUR",
) -> DataFrame:
    """Q8. Rows whose status does not follow from the key's preceding row.

    Staying in a status is no step. Adds `_previous`.
    """
    seen = previous_value(events, keys, status, at, tie, chunk=chunk)
    before, now = F.col("_previous"), F.col(status)
    return seen.filter(before.isNotNull() & (before != now) & ~_is_step(before, now, allowed))


def illegal_pairs(
    events: DataFrame, allowed: Sequence[tuple[str, str]],
    status_from: str = "status_from", status_to: str = "status_to",
) -> DataFrame:
    """Q8 for events that state both ends of the step: no history needed, no shuffle."""
    return events.filter(~F.coalesce(_is_step(F.col(status_from), F.col(status_to), allowed), F.lit(False)))


def apply_delivery_notices(
    orders: DataFrame, notices: DataFrame, key: str = "order_id", status: str = "status",
    delivered: str = "delivered",
) -> DataFrame:
    """Q9. Orders with a delivery notice become delivered; the notice stream stays read-only."""
    told = notices.select(F.col(key)).dropna().distinct().withColumn("_told", F.lit(True))
    return (
        orders.join(told, key, "left")
        .withColumn(status, F.when(F.col("_told"), F.lit(delivered)).otherwise(F.col(status)))
        .drop("_told")
    )


def apply_stock_updates(
    products: DataFrame, updates: DataFrame, key: str, at: str, ties: Sequence[str],
    stock: str = "stock_quantity", price: str = "price",
    new_stock: str = "new_stock", new_price: str = "new_price",
) -> DataFrame:
    """Q10. Products with the newest stock and price update of each key."""
    newest = latest_per_key(updates, [key], at, ties).select(
        key, F.col(new_stock).alias("_stock"), F.col(new_price).alias("_price")
    )
    return (
        products.join(newest, key, "left")
        .withColumns({
            stock: F.coalesce(F.col("_stock"), F.col(stock)),
            price: F.coalesce(F.col("_price"), F.col(price)),
        })
        .drop("_stock", "_price")
    )
