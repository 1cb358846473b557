"""The star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.functions.times import date_parts, elapsed_days
from siltstone.operators.dedup import latest_per_key
from siltstone.operators.skew import skew_join


def dim_customers(customers: DataFrame) -> DataFrame:
    """G1. A missing first or last name does not blank the whole name."""
    return customers.select(
        F.col("id").alias("customer_key"),
        F.concat_ws(" ", "first_name", "last_name").alias("customer_name"),
        "email", "gender", "date_of_birth",
        F.col("created_at").alias("customer_since"),
    )


def dim_products(products: DataFrame) -> DataFrame:
    """G2."""
    return products.select(
        F.col("id").alias("product_key"), "sku", F.col("name").alias("product_name"), "brand",
        "category_id", F.col("price").alias("list_price"), "cost", "is_active",
    )


def dim_payments(payments: DataFrame) -> DataFrame:
    """G3."""
    return payments.select(
        F.col("id").alias("payment_key"), "order_id", "payment_method",
        F.col("amount").alias("payment_amount"), F.col("status").alias("payment_status"),
        "transaction_id", "paid_at",
    )


def dim_shipping(shipping: DataFrame) -> DataFrame:
    """G4."""
    return shipping.select(
        F.col("id").alias("shipping_key"), "order_id", "carrier", "tracking_number",
        F.col("status").alias("shipping_status"), "shipped_at", "delivered_at",
        elapsed_days(F.col("shipped_at"), F.col("delivered_at")).alias("delivery_days"),
    )


def dim_date(df: DataFrame, column: str, first: str = "1900-01-01", last: str = "2199-12-31") -> DataFrame:
    """G5. Every calendar day from the first to the last date of `column` between `first` and `last`, and those dates outside that occur.

    So every dated row has its day, while a date that is wrong by centuries doesn't bring all the days up to it.
    """
    day = F.col("date")
    dated = df.select(F.col(column).cast("date").alias("d")).filter(F.col("d").isNotNull())
    usual = F.col("d").between(F.lit(first).cast("date"), F.lit(last).cast("date"))
    span = dated.agg(F.min(F.when(usual, F.col("d"))).alias("a"), F.max(F.when(usual, F.col("d"))).alias("b"))
    days = span.select(F.explode(F.sequence("a", "b", F.expr("INTERVAL 1 DAY"))).alias("date"))
    return days.union(dated.filter(~usual).distinct()).select(
        (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).alias("date_key"),
        "date",
        F.year(day).alias("year"), F.quarter(day).alias("quarter"), F.month(day).alias("month"),
        F.dayofmonth(day).alias("day"), (F.weekday(day) + 1).alias("iso_weekday"),
        F.weekofyear(day).alias("iso_week"), (F.weekday(day) >= 5).alias("is_weekend"),
    )


def fact_sales(
    items: DataFrame, orders: DataFrame, customers: DataFrame, products: DataFrame,
    payments: DataFrame, shipping: DataFrame, *, fanout: bool = False,
) -> DataFrame:
    """J1 + J2. One row per order item, from silver orders/items and the four dimensions.

    Everything known per order is joined at order grain first, on small rows; items then meet one
    wide order row and one product. Payments and shipments are
    reduced to the latest per order, so item rows and revenue are not multiplied (`fanout_rows`
    tells by how much they would be). With `fanout` every payment and shipment of an order repeats its items instead.
    """
    pay = payments.select("order_id", "payment_key", "payment_method", "payment_status", "paid_at")
    ship = shipping.select(
        "order_id", "shipping_key", "carrier", "shipping_status", "delivery_days", "shipped_at"
    )
    if not fanout:
        pay = latest_per_key(pay.dropna(subset=["order_id"]), ["order_id"], "paid_at", ["payment_key"])
        ship = latest_per_key(ship.dropna(subset=["order_id"]), ["order_id"], "shipped_at", ["shipping_key"])
    head = orders.select(
        F.col("id").alias("order_id"), "customer_id", F.col("status").alias("order_status"),
        "order_date", *date_parts(F.col("order_date"), "order"),
        "subtotal", "discount_amount", "tax_amount", "shipping_cost",
        F.col("total_amount").alias("order_total"),
    ).filter(F.col("order_year").isNotNull() & F.col("order_month").isNotNull())
    buyers = customers.select(
        F.col("customer_key").alias("customer_id"), "customer_key", "customer_name", "gender"
    )
    goods = products.select(
        F.col("product_key").alias("product_id"), "product_key", "sku", "product_name", "brand", "list_price"
    )
    per_order = skew_join(head, buyers, ["customer_id"], "left").join(
        pay.drop("paid_at"), "order_id", "left"
    ).join(ship.drop("shipped_at"), "order_id", "left")
    lines = items.select(
        F.col("id").alias("order_item_key"), "order_id", "product_id", "quantity", "unit_price",
        F.col("total_price").alias("item_total"),
    )
    placed = skew_join(lines, per_order, ["order_id"], "inner")
    sold = skew_join(placed, goods, ["product_id"], "left")
    return sold.select(
        "order_item_key", F.col("order_id").alias("order_key"), "customer_key", "product_key",
        "payment_key", "shipping_key",
        "order_status", "order_date", "order_year", "order_month", "order_day",
        "subtotal", "discount_amount", "tax_amount", "shipping_cost", "order_total",
        "quantity", "unit_price", "item_total",
        "customer_name", "gender", "sku", "product_name", "brand", "list_price",
        "payment_method", "payment_status", "carrier", "shipping_status", "delivery_days",
    )


def fanout_rows(items: DataFrame, orders: DataFrame, payments: DataFrame, shipping: DataFrame) -> DataFrame:
    """Item rows a star join without reduction would repeat for each payment (NULL: none).

    Worked out from counts per order; the repeated rows themselves are never formed.
    """
    lines = items.groupBy("order_id").agg(F.count(F.lit(1)).alias("_lines"))
    ships = shipping.groupBy("order_id").agg(F.count(F.lit(1)).alias("_ships"))
    per_order = (
        orders.select(F.col("id").alias("order_id")).join(lines, "order_id").join(ships, "order_id", "left")
        .select("order_id", (F.col("_lines") * F.coalesce("_ships", F.lit(1))).alias("_rows"))
    )
    paid = skew_join(payments.select("order_id", "payment_key"), per_order, ["order_id"], "inner")
    unpaid = per_order.join(payments.select("order_id").dropna().distinct(), "order_id", "left_anti")
    both = paid.select("payment_key", "_rows").unionByName(
        unpaid.select(F.lit(None).cast(payments.schema["payment_key"].dataType).alias("payment_key"), "_rows")
    )
    return both.groupBy("payment_key").agg(F.sum("_rows").alias("rows"))
