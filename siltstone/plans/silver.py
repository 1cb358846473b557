"""Silver entities (Q13).

Every recipe has the same course: parse, repair and type, keep one version per key, tag broken
rules and route, drop deletes. Nothing is filtered before the version is chosen, so a bad new version
never lets an old one back in, and rows in = silver + dead letters + superseded versions + deletes.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone import schemas, vocab
from siltstone.functions import text
from siltstone.functions.numbers import to_bool, to_money
from siltstone.functions.times import epoch_to_ts, iso_ts
from siltstone.operators import quality as q
from siltstone.operators.missing import placeholders_to_null
from siltstone.operators.parse import (
    LINEAGE, drop_deletes, keep_event_types, parse_cdc, parse_flat_envelope, parse_nested_envelope,
    parse_payload,
)
from siltstone.operators.skew import skew_join
from siltstone.operators.status import PAYMENT_STAMPS, SHIPPING_STAMPS

SILVER, DEAD_LETTER, QUARANTINE = "silver", "dead_letter", "quarantine"
STEP_WEIGHT = 3  # of a status event that moves nothing


def clean_key(key: str, value: Column) -> Column:
    """The key of an entity as its rows have it: placeholders are NULL, SKUs have one spelling. Recipes and records share it."""
    if key in ("sku", "transaction_id", "tracking_number"):
        value = text.blank_to_null(value)
    return text.sku_simple(value) if key == "sku" else value


def _times(*columns: str, date: Sequence[str] = ()) -> tuple[dict[str, Column], list[q.Rule], list[str]]:
    """Epoch columns typed; the rules that report values which no time can hold, and the columns that these need."""
    typed = {c: epoch_to_ts(F.col(c), "ms") for c in columns}
    lost = {f"_lost_{c}": F.col(c).isNotNull() & t.isNull() for c, t in typed.items()}
    dates = {c: typed[c].cast("date") for c in date}
    rules = [q.Rule(f"unreadable_{c}", F.col(f"_lost_{c}"), 1, rejects=False) for c in columns]
    return {**typed, **dates, **lost}, rules, list(lost)


def _is_bad(df: DataFrame, rules: Sequence[q.Rule]) -> Column:
    bad = q.any_rejects(rules)
    if "_quality_flag" in df.columns:
        bad = bad | F.coalesce(F.col("_quality_flag").isin(vocab.DIRTY, vocab.QUARANTINE), F.lit(False))
    return bad


def _resolve(df: DataFrame, rules: Sequence[q.Rule], key: str, order: Sequence[Column]) -> DataFrame:
    """One version per key, tagged and routed.

    Whether a row is bad is settled before the shuffle, so that only bad rows carry their message
    through it; reasons and score are worked out for the surviving rows only. Messages without a
    key are all kept (identical ones once).
    """
    bad = _is_bad(df, rules)
    slim = df.withColumns({
        "_raw": F.when(bad, F.col("raw_data")),
        "_keyless": F.when(F.col(key).isNull(), F.col("raw_data")),
    }).drop("raw_data")
    place = F.row_number().over(Window.partitionBy(key, "_keyless").orderBy(*order))
    kept = slim.withColumn("_place", place).filter(F.col("_place") == 1).drop("_place", "_keyless")
    route = F.when(_is_bad(kept, rules), DEAD_LETTER).otherwise(SILVER)
    return q.tag_rules(kept, rules).withColumn("_route", route).withColumnRenamed("_raw", "raw_data")


def _newest(df: DataFrame) -> list[Column]:
    ties = [c for c in reversed(LINEAGE) if c in df.columns]
    return [F.col(c).desc_nulls_last() for c in ["__source_ts_ms", *ties]]


def accepted(routed: DataFrame) -> DataFrame:
    """The silver table: accepted rows without the routing columns."""
    helpers = {"_route", "_reasons", "_dirty_score", "raw_data", "__op", "__table", "__deleted"}
    return routed.filter(F.col("_route") == SILVER).drop(*helpers)


def rejected(routed: DataFrame) -> DataFrame:
    return routed.filter(F.col("_route") != SILVER)


def orders(bronze: DataFrame, topic: str = "erp.public.orders", schema: str = schemas.CDC["orders"]) -> DataFrame:
    rows = placeholders_to_null(parse_cdc(bronze, topic, schema, raw=True), ["status", "total_amount"])
    amounts = ["subtotal", "discount_amount", "tax_amount", "shipping_cost", "total_amount"]
    times, unreadable, lost = _times("order_date", "created_at")
    typed = rows.withColumns({
        **{c: to_money(F.col(c)) for c in amounts}, **times,
    })
    rules = [
        q.null_rule("id"), q.null_rule("customer_id"), q.null_rule("total_amount"),
        q.not_positive("total_amount"), q.status_typo(), *unreadable,
    ]
    current = drop_deletes(_resolve(typed, rules, "id", _newest(typed))).drop(*lost)
    return current.withColumn("status", text.enum_or_null(F.col("status"), vocab.ORDER_STATUSES))


def customers(bronze: DataFrame, topic: str = "erp.public.customers", schema: str = schemas.CDC["customers"]) -> DataFrame:
    rows = placeholders_to_null(parse_cdc(bronze, topic, schema, raw=True), ["email", "phone"])
    times, unreadable, lost = _times("date_of_birth", "created_at", date=["date_of_birth"])
    typed = rows.withColumns({
        "email": text.lower_trim(F.col("email")),
        "first_name": text.title_trim(F.col("first_name")),
        "last_name": text.title_trim(F.col("last_name")),
        "gender": text.upper_trim(F.col("gender")), **times,
    })
    rules = [q.null_rule("id"), q.null_rule("email"), q.invalid_email(), *unreadable]
    return drop_deletes(_resolve(typed, rules, "id", _newest(typed))).drop(*lost)


def order_items(bronze: DataFrame, topic: str = "erp.public.order_items", schema: str = schemas.CDC["order_items"]) -> DataFrame:
    rows = parse_cdc(bronze, topic, schema, raw=True)
    typed = rows.withColumns({c: to_money(F.col(c)) for c in ("unit_price", "total_price")})
    rules = [
        q.null_rule("id"), q.null_rule("order_id"), q.null_rule("product_id"),
        q.null_rule("quantity"), q.not_positive("quantity"),
    ]
    return drop_deletes(_resolve(typed, rules, "id", _newest(typed)))


def products(bronze: DataFrame, topic: str = "erp.public.products", schema: str = schemas.CDC["products"]) -> DataFrame:
    rows = placeholders_to_null(parse_cdc(bronze, topic, schema, raw=True), ["name", "sku", "brand"])
    times, unreadable, lost = _times("created_at", "updated_at")
    typed = rows.withColumns({
        "sku": text.sku_simple(F.col("sku")),
        "name": F.trim("name"),
        "brand": text.title_trim(F.col("brand")),
        **{c: to_money(F.col(c)) for c in ("price", "cost")},
        "weight": F.col("weight").try_cast("double"), **times,
    })
    rules = [q.null_rule(c) for c in ("id", "sku", "name", "price")] + [q.not_positive("price"), *unreadable]
    return drop_deletes(_resolve(typed, rules, "id", _newest(typed))).drop(*lost)


def warehouse_products(bronze: DataFrame, schema: str = schemas.WAREHOUSE_LIFECYCLE) -> DataFrame:
    """Product lifecycle events, newest per SKU. A redelivered event repeats its SKU, so keeping
    one row per SKU also removes redeliveries."""
    events = keep_event_types(parse_flat_envelope(bronze, schema, raw=True), vocab.PRODUCT_LIFECYCLE_EVENTS)
    rows = placeholders_to_null(events, ["name", "brand"])
    typed = rows.withColumns({
        "sku": clean_key("sku", F.col("sku")),
        "name": F.trim("name"),
        "brand": text.title_trim(F.col("brand")),
        **{c: to_money(F.col(c)) for c in ("price", "cost")},
        "weight": F.col("weight").try_cast("double"),
        "is_active": to_bool(F.col("is_active")),
        **{c: iso_ts(F.col(c)) for c in ("_ingested_at", "created_at", "updated_at")},
    })
    rules = [q.null_rule(c) for c in ("sku", "name", "price")] + [q.not_positive("price")]
    order = [F.col("_ingested_at").desc_nulls_last(), F.col("_event_id").desc_nulls_last()]
    return _resolve(typed, rules, "sku", order)


def _gateway_events(bronze: DataFrame, prefix: str, schema: str) -> DataFrame:
    """Events of one kind, parsed once for both creations and status steps.

    `_created` is a column and not a filter: filters are pushed into the scan, where each would
    parse the JSON text again.
    """
    events = parse_payload(parse_nested_envelope(bronze, raw=True), prefix, schema)
    return events.withColumns({
        "_ingested_at": iso_ts(F.col("_ingested_at")),
        "_created": ~F.endswith("_event_type", F.lit(".status_updated")),
        "status_to": F.upper("status_to"),
    })


def _current_state(
    events: DataFrame, rules: Sequence[q.Rule], key: str, stamps: Mapping[str, str], fold: bool
) -> DataFrame:
    """One row per key: the earliest creation, moved forward by the key's good status events; and a dead letter for every
    status event that moves nothing, because it is flagged, lacks its key or its status, or has no creation.

    Creations and steps meet in one aggregate over one shuffle (combined map-side). Creations
    without a key are all kept (identical ones once).
    """
    bad = _is_bad(events, rules)
    flagged = F.coalesce(F.col("_quality_flag").isin(vocab.DIRTY, vocab.QUARANTINE), F.lit(False))
    unusable = flagged | F.col(key).isNull() | F.col("status_to").isNull()
    slim = events.withColumns({
        "_raw": F.when(bad, F.col("raw_data")),
        "_keyless": F.when(F.col(key).isNull() & F.col("_created"), F.col("raw_data")),
        "_moves": ~F.col("_created") & ~unusable,
    }).drop("raw_data", "status_from")
    grouping = {key, "_keyless", "_created", "_moves", "status_to"}
    body = [c for c in slim.columns if c not in grouping]
    at, event = F.col("_ingested_at"), F.col("_event_id")
    created, step = F.col("_created"), F.col("_moves")
    first = F.when(created, F.struct(at.isNull().alias("late"), at, event))  # missing times last
    last = F.when(step, F.struct(at, event))
    merged = slim.groupBy(key, "_keyless").agg(
        F.min_by(F.struct(*body), first).alias("_body"),
        F.max_by("status_to", last).alias("_status"),
        *[F.min(F.when(step & (F.col("status_to") == v.upper()), at)).alias(f"_{n}") for n, v in stamps.items()],
    )
    known = F.col("_body").isNotNull()
    kept = merged.filter(known).select(
        key, "_body.*", "_status", *[f"_{n}" for n in stamps]
    )
    route = F.when(_is_bad(kept, rules), DEAD_LETTER).otherwise(SILVER)
    out = q.tag_rules(kept, rules).withColumn("_route", route).withColumnRenamed("_raw", "raw_data")
    if fold:
        out = out.withColumns({
            "status": F.coalesce("_status", "status"), **{n: F.coalesce(n, f"_{n}") for n in stamps}
        })
    out = out.drop("_status", *[f"_{n}" for n in stamps])
    # The steps once more, against the keys that have a creation.
    made = events.filter(F.col("_created") & F.col(key).isNotNull()).select(key).distinct().withColumn("_made", F.lit(True))
    steps = skew_join(events.filter(~F.col("_created")), made, [key], "left")
    why = F.filter(F.array(
        F.when(flagged, "dirty_step"), F.when(F.col(key).isNull(), "step_without_key"),
        F.when(F.col("status_to").isNull(), "step_without_status"),
        F.when(~unusable & F.col("_made").isNull(), "unmatched_step")), lambda x: x.isNotNull())
    rejects = steps.filter(unusable | F.col("_made").isNull()).withColumns({
        "_reasons": why, "_dirty_score": F.lit(STEP_WEIGHT), "_route": F.lit(DEAD_LETTER)})
    return out.unionByName(rejects.select(*out.columns))


def payments(bronze: DataFrame, schema: str = schemas.PAYLOAD["payment"], *, fold: bool = True) -> DataFrame:
    """Payments: the earliest creation per transaction, moved forward by its status events."""
    events = placeholders_to_null(
        _gateway_events(bronze, "payment.", schema), ["payment_method", "status"]
    )
    typed = events.withColumns({
        "transaction_id": clean_key("transaction_id", F.col("transaction_id")),
        "id": F.coalesce("id", "payment_id"),
        "amount": to_money(F.col("amount")),
        "paid_at": iso_ts(F.col("paid_at")),
        "status": text.enum_or_null(F.col("status"), vocab.PAYMENT_STATUSES),
    }).drop("payment_id")
    rules = [
        q.null_rule("order_id"), q.null_rule("transaction_id"), q.null_rule("amount"),
        q.not_positive("amount"), q.invalid_payment_method(),
    ]
    method = F.upper(text.snake_category(F.col("payment_method")))
    return _current_state(typed, rules, "transaction_id", PAYMENT_STAMPS, fold).withColumn(
        "payment_method", text.enum_or_null(method, vocab.PAYMENT_METHODS)
    )


def shipping(bronze: DataFrame, schema: str = schemas.PAYLOAD["shipping"], *, fold: bool = True) -> DataFrame:
    """Shipments: the earliest creation per tracking number, moved forward by its status events."""
    typed = _gateway_events(bronze, "shipping.", schema).withColumns({
        "id": F.coalesce("id", "shipping_id"),
        "tracking_number": clean_key("tracking_number", F.col("tracking_number")),
        "status": text.enum_or_null(F.col("status"), vocab.SHIPPING_STATUSES),
        **{c: iso_ts(F.col(c)) for c in ("shipped_at", "delivered_at")},
        "estimated_delivery": iso_ts(F.col("estimated_delivery")).cast("date"),
    }).drop("shipping_id")
    rules = [q.null_rule("order_id"), q.null_rule("tracking_number")]
    return _current_state(typed, rules, "tracking_number", SHIPPING_STAMPS, fold)


def _gateway_records(bronze: DataFrame, prefix: str, schema: str) -> DataFrame:
    """Events of a kind that is only ever created, typed as far as all kinds are."""
    events = parse_payload(parse_nested_envelope(bronze, raw=True), prefix, schema)
    return events.withColumn("_ingested_at", iso_ts(F.col("_ingested_at")))


def _latest_event() -> list[Column]:
    return [F.col("_ingested_at").desc_nulls_last(), F.col("_event_id").desc_nulls_last()]


def reviews(bronze: DataFrame, schema: str = schemas.PAYLOAD["review"]) -> DataFrame:
    """Product reviews, newest event per review."""
    rows = placeholders_to_null(_gateway_records(bronze, "review.", schema), ["title", "comment"])
    rules = [q.null_rule(c) for c in ("review_id", "product_id", "rating")]
    rules.append(q.Rule("rating_out_of_range", ~F.col("rating").between(1, 5), 2))
    return _resolve(rows, rules, "review_id", _latest_event())


def feedback(bronze: DataFrame, schema: str = schemas.PAYLOAD["feedback"]) -> DataFrame:
    """Customer feedback, newest event per ticket."""
    rows = placeholders_to_null(_gateway_records(bronze, "feedback.", schema), ["type", "subject", "priority", "status"])
    return _resolve(rows, [q.null_rule("feedback_id"), q.null_rule("customer_id")], "feedback_id", _latest_event())


def delivery_notices(bronze: DataFrame, schema: str = schemas.PAYLOAD["delivery_notice"]) -> DataFrame:
    """Notices that an order was delivered, for `apply_delivery_notices`; flagged ones are left out."""
    rows = _gateway_records(bronze, "order.delivered_notification", schema)
    good = ~F.coalesce(F.col("_quality_flag").isin(vocab.DIRTY, vocab.QUARANTINE), F.lit(False))
    return rows.filter(good & F.col("order_id").isNotNull()).select("order_id", "shipping_id", "_event_id", "_ingested_at")


def stock_updates(bronze: DataFrame, schema: str = schemas.WAREHOUSE_STOCK) -> DataFrame:
    """Stock and price updates, for `apply_stock_updates`; flagged ones and unusable numbers are left out."""
    rows = keep_event_types(parse_flat_envelope(bronze, schema), ["product.stock_updated"])
    good = ~F.coalesce(F.col("_quality_flag").isin(vocab.DIRTY, vocab.QUARANTINE), F.lit(False))
    price = to_money(F.col("new_price"))
    return rows.filter(good & F.col("product_id").isNotNull()).select(
        "product_id", iso_ts(F.col("updated_at")).alias("updated_at"), "_event_id",
        F.when(F.col("new_stock") >= 0, F.col("new_stock")).alias("new_stock"), F.when(price > 0, price).alias("new_price"))
