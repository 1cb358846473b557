"""Fixed business values: the vocabularies, formats and routes the platform is defined by.

Everything here is data that results depend on, kept together as plain text.
"""

from __future__ import annotations

# --- fixed values -------------------------------------------------------------------------------

# Text that stands for "no value" once trimmed (case-sensitive).
PLACEHOLDERS = (
    "UNKNOWN", "N/A", "#N/A", "None", "null", "EMPTY", "--", "???", "TBD", "not available", "",
)

ORDER_STATUSES = ("PENDING", "PROCESSING", "SHIPPED", "DELIVERED", "CANCELLED", "RETURNED")
PAYMENT_METHODS = ("CREDIT_CARD", "DEBIT_CARD", "PAYPAL", "APPLE_PAY", "GOOGLE_PAY")
PAYMENT_STATUSES = ("PENDING", "COMPLETED", "FAILED", "REFUNDED")
SHIPPING_STATUSES = (
    "PENDING", "PICKED_UP", "IN_TRANSIT", "OUT_FOR_DELIVERY", "DELIVERED", "RETURNED",
)
PRODUCT_LIFECYCLE_EVENTS = ("product.created", "product.updated")

# Known misspellings of categorical values.
STATUS_TYPOS = {
    "pendng": "pending",
    "shiped": "shipped",
    "deliverd": "delivered",
    "procesing": "processing",
    "cancled": "cancelled",
    "completd": "completed",
    "confirmd": "confirmed",
    "refundd": "refunded",
    "faild": "failed",
}

# Date shapes in the order they are tried.
DATE_FORMATS = ("yyyy-MM-dd", "dd/MM/yyyy", "MM-dd-yyyy", "dd.MM.yyyy", "MMM d, yyyy")
DATETIME_FORMAT = "yyyy-MM-dd HH:mm:ss"

# Landing table -> regular expression that must match the whole topic name.
TOPIC_ROUTES = {
    "erp_raw": r"erp\.public\..*",
    "wh_raw": r"warehouse\.events",
    "wh_dlq": r"warehouse\.events\.dlq",
    "pay_raw": r"payment\.events",
    "pay_dlq": r"payment\.events\.dlq",
}

# Topics every healthy installation is expected to carry messages on.
EXPECTED_TOPICS = (
    "erp.public.customers", "erp.public.orders", "erp.public.order_items",
    "erp.public.coupons", "erp.public.products",
    "warehouse.events", "warehouse.events.dlq", "payment.events", "payment.events.dlq",
)

# Allowed single steps of each status machine.
ORDER_FLOW = (("pending", "processing"), ("processing", "shipped"), ("shipped", "delivered"))
PAYMENT_FLOW = (("pending", "completed"), ("pending", "failed"), ("completed", "refunded"))
SHIPPING_FLOW = (
    ("pending", "picked_up"), ("picked_up", "in_transit"),
    ("in_transit", "out_for_delivery"), ("out_for_delivery", "delivered"),
)

# child table, foreign key, parent table (all parents are keyed by `id`).
FOREIGN_KEYS = (
    ("orders", "customer_id", "customers"),
    ("orders", "shipping_address_id", "addresses"),
    ("orders", "billing_address_id", "addresses"),
    ("orders", "coupon_id", "coupons"),
    ("order_items", "order_id", "orders"),
    ("order_items", "product_id", "products"),
    ("payments", "order_id", "orders"),
    ("shipping", "order_id", "orders"),
    ("reviews", "product_id", "products"),
    ("reviews", "customer_id", "customers"),
    ("reviews", "order_id", "orders"),
    ("feedback", "customer_id", "customers"),
    ("feedback", "order_id", "orders"),
    ("addresses", "customer_id", "customers"),
    ("products", "category_id", "categories"),
    ("categories", "parent_category_id", "categories"),
)

CLEAN, DIRTY, QUARANTINE = "CLEAN", "DIRTY", "QUARANTINE"
MAX_PHONE_LENGTH = 20
FRESH_SECONDS, STALE_SECONDS = 60, 600
LATE_MINUTES = 10
SQL_ROW_CAP = 100
WRITE_VERBS = ("DROP", "DELETE", "UPDATE", "INSERT", "TRUNCATE", "ALTER", "CREATE", "MERGE")
