"""Static schemas (DDL strings). Money travels as text and is typed by the silver recipes."""

from __future__ import annotations

# --- fixed values: names and types of the messages' and tables' fields, as the sources send them --

# --- landing ------------------------------------------------------------------------------------

MESSAGE = (
    "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp"
)
BRONZE = (
    "raw_data string, kafka_key string, _source_topic string, _kafka_partition int, "
    "_kafka_offset bigint, _kafka_timestamp timestamp, _bronze_ingested_at timestamp, "
    "ingest_date date"
)

# --- change-data rows (flat JSON) ---------------------------------------------------------------

_CDC_META = "__op string, __table string, __source_ts_ms bigint, __deleted string"

CDC = {
    "orders": (
        "id bigint, customer_id bigint, shipping_address_id bigint, billing_address_id bigint, "
        "coupon_id bigint, status string, subtotal string, discount_amount string, "
        "tax_amount string, shipping_cost string, total_amount string, order_date bigint, "
        f"created_at bigint, {_CDC_META}"
    ),
    "customers": (
        "id bigint, first_name string, last_name string, email string, phone string, "
        f"gender string, date_of_birth bigint, created_at bigint, {_CDC_META}"
    ),
    "order_items": (
        "id bigint, order_id bigint, product_id bigint, quantity int, unit_price string, "
        f"total_price string, {_CDC_META}"
    ),
    "products": (
        "id bigint, category_id bigint, name string, description string, sku string, "
        "price string, cost string, stock_quantity int, brand string, weight string, "
        f"is_active boolean, created_at bigint, updated_at bigint, {_CDC_META}"
    ),
}

# --- warehouse drops (flat envelope) ------------------------------------------------------------

_FLAT_META = (
    "_source_system string, _schema_version string, _event_id string, _event_type string, "
    "_ingested_at string, _quality_flag string, _dirty_reason string"
)
WAREHOUSE_LIFECYCLE = (
    f"{_FLAT_META}, category_id bigint, name string, description string, sku string, "
    "price string, cost string, stock_quantity int, brand string, weight string, "
    "is_active string, created_at string, updated_at string"
)
WAREHOUSE_STOCK = (
    f"{_FLAT_META}, product_id bigint, event string, updated_at string, new_stock int, "
    "new_price string"
)

# --- gateway webhooks (nested envelope) ---------------------------------------------------------

ENVELOPE_META = (
    "_source_system string, _event_id string, _event_type string, _op_type string, "
    "_ingested_at string, _quality_flag string"
)
PAYLOAD = {
    "payment": (
        "id bigint, payment_id bigint, order_id bigint, payment_method string, amount string, "
        "status string, transaction_id string, paid_at string, status_from string, "
        "status_to string, gateway_meta string, _dirty_reason string"
    ),
    "shipping": (
        "id bigint, shipping_id bigint, order_id bigint, carrier string, tracking_number string, "
        "status string, shipped_at string, delivered_at string, estimated_delivery string, "
        "status_from string, status_to string"
    ),
    "delivery_notice": "order_id bigint, shipping_id bigint, event string, note string",
    "review": (
        "review_id bigint, product_id bigint, customer_id bigint, order_id bigint, rating int, "
        "title string, comment string, is_verified boolean"
    ),
    "feedback": (
        "feedback_id bigint, customer_id bigint, order_id bigint, type string, subject string, "
        "priority string, status string"
    ),
}

# --- relational source tables -------------------------------------------------------------------

TABLES = {
    "customers": (
        "id bigint, first_name string, last_name string, email string, phone string, "
        "gender string, date_of_birth date, created_at timestamp, updated_at timestamp"
    ),
    "addresses": (
        "id bigint, customer_id bigint, type string, street string, city string, state string, "
        "zip_code string, country string, is_default boolean, created_at timestamp"
    ),
    "categories": (
        "id bigint, name string, description string, parent_category_id bigint, "
        "created_at timestamp"
    ),
    "products": (
        "id bigint, category_id bigint, name string, description string, sku string, "
        "price decimal(12,2), cost decimal(12,2), stock_quantity int, brand string, "
        "weight double, is_active boolean, created_at timestamp, updated_at timestamp"
    ),
    "coupons": (
        "id bigint, code string, discount_type string, discount_value decimal(12,2), "
        "min_order_amount decimal(12,2), max_uses int, times_used int, valid_from date, "
        "valid_until date, is_active boolean, created_at timestamp"
    ),
    "orders": (
        "id bigint, customer_id bigint, shipping_address_id bigint, billing_address_id bigint, "
        "coupon_id bigint, status string, subtotal decimal(12,2), discount_amount decimal(12,2), "
        "tax_amount decimal(12,2), shipping_cost decimal(12,2), total_amount decimal(12,2), "
        "order_date timestamp, created_at timestamp, updated_at timestamp"
    ),
    "order_items": (
        "id bigint, order_id bigint, product_id bigint, quantity int, unit_price decimal(12,2), "
        "total_price decimal(12,2), created_at timestamp"
    ),
    "payments": (
        "id bigint, order_id bigint, payment_method string, amount decimal(12,2), status string, "
        "transaction_id string, paid_at timestamp, created_at timestamp"
    ),
    "shipping": (
        "id bigint, order_id bigint, carrier string, tracking_number string, status string, "
        "shipped_at timestamp, estimated_delivery date, delivered_at timestamp, "
        "created_at timestamp, updated_at timestamp"
    ),
    "reviews": (
        "id bigint, product_id bigint, customer_id bigint, order_id bigint, rating int, "
        "title string, comment string, is_verified boolean, created_at timestamp"
    ),
    "feedback": (
        "id bigint, customer_id bigint, order_id bigint, type string, subject string, "
        "message string, status string, priority string, created_at timestamp, "
        "resolved_at timestamp"
    ),
}
