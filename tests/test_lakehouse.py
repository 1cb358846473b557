"""Bronze to gold on files, streams against their batch forms, and the plans behind them."""

import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from siltstone import schemas
from siltstone.operators.parse import parse_cdc
from siltstone.operators.quality import null_rule
from siltstone.operators.reports import layer_counts, quality_counts
from siltstone.plans import cleaning, gold, lakehouse, silver
from siltstone.sources import csv_drops
from siltstone.sources.bronze import read_topics, to_bronze
from siltstone.sources.versions import VersionedTable
from siltstone.streaming import flows

T0 = datetime(2024, 3, 1)
MS = 1709251200000


def message(topic, body, offset):
    raw = body if isinstance(body, str) else json.dumps(body)
    return (b"k", raw.encode(), topic, 0, offset, T0 + timedelta(seconds=offset))


def order(i, ts, op="c", **more):
    base = {"id": i, "customer_id": 1, "status": "pending", "subtotal": "90.00", "discount_amount": "0", "tax_amount": "10.00",
            "shipping_cost": "0", "total_amount": "100.00", "order_date": MS, "created_at": MS, "__op": op, "__source_ts_ms": ts}
    return {**base, **more}


def envelope(kind, event, at, payload, flag="CLEAN"):
    return {"_source_system": "payment_gw", "_schema_version": "1", "_event_id": event, "_event_type": kind, "_op_type": "c",
            "_ingested_at": at, "_quality_flag": flag, "payload": payload}


MESSAGES = [
    ("erp.public.orders", order(1, 1)),
    ("erp.public.orders", order(1, 2, "u", status="SHIPPED")),
    ("erp.public.orders", order(2, 1)),
    ("erp.public.orders", order(2, 3, "d")),
    ("erp.public.orders", order(3, 1)),
    ("erp.public.orders", order(3, 2, "u", total_amount="-5")),  # the newer, bad version must not revive the older
    ("erp.public.orders", order(4, 1, total_amount="abc")),
    ("erp.public.orders", order(5, 1, status="PANDING")),
    ("erp.public.orders", "{broken"),
    ("erp.public.customers", {"id": 1, "first_name": " aNNa", "last_name": "lee ", "email": " A@B.CO ", "gender": "female", "date_of_birth": 0, "created_at": MS, "__op": "c", "__source_ts_ms": 1}),
    ("erp.public.customers", {"id": 2, "first_name": "Bo", "last_name": None, "email": "bo.example.com", "__op": "c", "__source_ts_ms": 1}),
    ("erp.public.order_items", {"id": 10, "order_id": 1, "product_id": 7, "quantity": 2, "unit_price": "25.00", "total_price": "50.00", "__op": "c", "__source_ts_ms": 1}),
    ("erp.public.order_items", {"id": 11, "order_id": 1, "product_id": 8, "quantity": 1, "unit_price": "50.00", "total_price": "50.00", "__op": "c", "__source_ts_ms": 1}),
    ("erp.public.order_items", {"id": 12, "order_id": 5, "product_id": 7, "quantity": 0, "unit_price": "1", "total_price": "1", "__op": "c", "__source_ts_ms": 1}),
    ("erp.public.products", {"id": 7, "category_id": 1, "name": "Lamp", "sku": "sku_ab 1", "price": "25.00", "cost": "5", "brand": "acme", "is_active": True, "created_at": MS, "updated_at": MS, "__op": "c", "__source_ts_ms": 1}),
    ("erp.public.products", {"id": 8, "category_id": 1, "name": "Desk", "sku": "UNKNOWN", "price": "50.00", "brand": "acme", "__op": "c", "__source_ts_ms": 1}),
    ("warehouse.events", {"_event_id": "w1", "_event_type": "product.created", "_ingested_at": "2024-03-01T00:00:00", "_quality_flag": "CLEAN", "sku": "A 1", "name": "n", "price": "3", "is_active": "True"}),
    ("warehouse.events", {"_event_id": "w2", "_event_type": "product.stock_updated", "_ingested_at": "2024-03-01T00:00:00", "product_id": 1}),
    ("warehouse.events.dlq", {"_event_id": "w3", "_event_type": "product.created"}),
    ("payment.events", envelope("payment.created", "p1", "2024-03-01T00:00:00", {"payment_id": 5, "order_id": 1, "payment_method": "Credit Card", "amount": 100.0, "status": "pending", "transaction_id": "T1", "gateway_meta": {"bank": "x"}})),
    ("payment.events", envelope("payment.created", "p2", "2024-03-01T00:00:09", {"payment_id": 6, "order_id": 1, "payment_method": "paypal", "amount": 100.0, "status": "pending", "transaction_id": "T1"})),
    ("payment.events", envelope("payment.status_updated", "p3", "2024-03-01T01:00:00", {"payment_id": 5, "order_id": 1, "transaction_id": "T1", "status_from": "pending", "status_to": "completed", "amount": 100.0})),
    ("payment.events", envelope("payment.created", "p4", "2024-03-01T00:00:00", {"payment_id": 9, "order_id": 3, "payment_method": "bitcoin", "amount": -1, "transaction_id": "T2"})),
    ("payment.events", envelope("shipping.created", "s1", "2024-03-01T02:00:00", {"shipping_id": 3, "order_id": 1, "carrier": "DHL", "tracking_number": "K1", "status": "pending", "estimated_delivery": "2024-03-05"})),
    ("payment.events", envelope("shipping.status_updated", "s2", "2024-03-01T03:00:00", {"shipping_id": 3, "order_id": 1, "tracking_number": "K1", "status_from": "pending", "status_to": "picked_up"})),
    ("payment.events", envelope("shipping.status_updated", "s3", "2024-03-02T15:00:00", {"shipping_id": 3, "order_id": 1, "tracking_number": "K1", "status_from": "out_for_delivery", "status_to": "delivered"})),
    ("other.topic", {"id": 1}),
]


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("lake"))
    data = [message(t, b, i) for i, (t, b) in enumerate(MESSAGES)]
    spark.createDataFrame(data, schemas.MESSAGE).write.parquet(f"{root}/topics")
    first = lakehouse.run_bronze(spark, root, files=f"{root}/topics")
    again = lakehouse.run_bronze(spark, root, files=f"{root}/topics")
    lakehouse.run_silver(spark, root, F.lit(T0))
    return root, first, again


def test_bronze_is_landed_once(spark, lake):
    root, first, again = lake
    counts = {s: lakehouse.read_bronze(spark, root, s).count() for s in lakehouse.vocab.TOPIC_ROUTES}
    assert counts == {"erp_raw": 16, "wh_raw": 2, "wh_dlq": 1, "pay_raw": 7, "pay_dlq": 0}
    assert first["erp_raw"] > 0 and set(again.values()) == {0}
    assert lakehouse.read_bronze(spark, root, "erp_raw", since="2024-03-02").count() == 0


def silver_rows(spark, root, entity, *columns):
    return sorted(map(tuple, lakehouse.read_routed(spark, root, entity, silver.SILVER).select(*columns).collect()))


def test_silver_tables(spark, lake):
    root = lake[0]
    assert silver_rows(spark, root, "orders", "id", F.coalesce("status", F.lit("-"))) == [(1, "SHIPPED"), (5, "-")]
    assert silver_rows(spark, root, "customers", "id", "first_name", "last_name", "email", "gender") == [(1, "Anna", "Lee", "a@b.co", "FEMALE")]
    assert silver_rows(spark, root, "order_items", "id") == [(10,), (11,)]
    assert silver_rows(spark, root, "products", "id", "sku", "brand") == [(7, "SKU-AB-1", "Acme")]
    assert silver_rows(spark, root, "warehouse_events", "sku", "is_active") == [("A-1", True)]
    pay = lakehouse.read_routed(spark, root, "payments", silver.SILVER).first()
    assert (pay["id"], pay["payment_method"], pay["status"], pay["paid_at"]) == (5, "CREDIT_CARD", "COMPLETED", datetime(2024, 3, 1, 1))
    assert json.loads(pay["gateway_meta"]) == {"bank": "x"}
    ship = lakehouse.read_routed(spark, root, "shipping", silver.SILVER).first()
    assert (ship["id"], ship["status"], ship["shipped_at"]) == (3, "DELIVERED", datetime(2024, 3, 1, 3))


def test_dead_letters_keep_reason_and_message(spark, lake):
    dlq = VersionedTable(spark, f"{lake[0]}/silver/dlq").read()
    got = {(r["_source"], r["id"]): r for r in dlq.collect()}
    assert set(got) == {("erp.orders", "3"), ("erp.orders", "4"), ("erp.orders", None), ("erp.customers", "2"),
                        ("erp.order_items", "12"), ("erp.products", "8"), ("payment.payments", "9")}
    assert got[("erp.orders", "3")]["_reasons"] == ["non_positive_total_amount"]
    assert got[("erp.orders", None)]["raw_data"] == "{broken"
    assert json.loads(got[("erp.orders", "4")]["raw_data"])["total_amount"] == "abc"
    assert got[("payment.payments", "9")]["_reasons"] == ["non_positive_amount", "invalid_payment_method"]


def test_later_landings_are_merged(spark, lake, tmp_path):
    """Full run = run + merging run, for every entity, with lost and flagged steps, deletes and records without a key."""
    more = [
        ("erp.public.orders", order(1, 9, "d")), ("erp.public.orders", order(7, 1)), ("erp.public.orders", order(3, 3, "u", total_amount="7.00")),
        ("erp.public.orders", "{broken too"), ("erp.public.customers", {"id": 1, "first_name": "Ann", "email": "n@b.co", "__op": "u", "__source_ts_ms": 5}),
        ("warehouse.events", {"_event_id": "w9", "_event_type": "product.updated", "_ingested_at": "2024-03-09T00:00:00", "_quality_flag": "CLEAN", "sku": "a_1", "name": "m", "price": "4"}),
        ("payment.events", envelope("payment.status_updated", "p7", "2024-03-04T01:00:00", {"transaction_id": "T1", "status_to": "refunded"})),
        ("payment.events", envelope("payment.status_updated", "p8", "2024-03-05T01:00:00", {"transaction_id": "T1", "status_to": "failed"}, "DIRTY")),
        ("payment.events", envelope("payment.status_updated", "p9", "2024-03-05T01:00:00", {"transaction_id": "T9", "status_to": "completed"})),
        ("payment.events", envelope("payment.status_updated", "p10", "2024-03-05T01:00:00", {"transaction_id": "T1"})),
        ("payment.events", envelope("review.created", "r1", "2024-03-05T01:00:00", {"review_id": 1, "product_id": 7, "rating": 4})),
        ("payment.events", envelope("review.created", "r2", "2024-03-05T02:00:00", {"review_id": 2, "product_id": 7, "rating": 9})),
        ("payment.events", envelope("feedback.created", "f1", "2024-03-05T02:00:00", {"feedback_id": 3, "customer_id": 1, "type": "N/A"})),
        ("payment.events", envelope("order.delivered_notification", "n1", "2024-03-05T02:00:00", {"order_id": 5, "shipping_id": 3})),
        ("payment.events", envelope("order.delivered_notification", "n2", "2024-03-05T02:00:00", {"order_id": 7}, "DIRTY")),
        ("warehouse.events", {"_event_id": "w10", "_event_type": "product.stock_updated", "product_id": 7, "updated_at": "2024-03-05T00:00:00", "new_stock": 4, "new_price": "30"}),
        ("warehouse.events", {"_event_id": "w11", "_event_type": "product.stock_updated", "product_id": 7, "updated_at": "2024-03-06T00:00:00", "new_stock": 3, "new_price": "-1"}),
    ]
    root, late = str(tmp_path / "lake"), timedelta(days=5)
    first = [message(t, b, i) for i, (t, b) in enumerate(MESSAGES)]
    second = [(k, v, t, p, o, at + late) for k, v, t, p, o, at in (message(t, b, 100 + i) for i, (t, b) in enumerate(more))]
    spark.createDataFrame(first, schemas.MESSAGE).write.parquet(f"{root}/topics")
    lakehouse.run_bronze(spark, root, files=f"{root}/topics")
    lakehouse.run_silver(spark, root, F.lit(T0))
    spark.createDataFrame(second, schemas.MESSAGE).write.mode("append").parquet(f"{root}/topics")
    lakehouse.run_bronze(spark, root, files=f"{root}/topics")
    lakehouse.run_silver(spark, root, F.lit(T0), since="2024-03-06")

    def content():
        found = {}
        for entity in lakehouse.ENTITIES:
            df = lakehouse.read_silver(spark, root, entity)
            found[entity] = sorted(str(sorted(r.asDict().items())) for r in df.collect())
        return found

    merged = content()
    lakehouse.run_silver(spark, root, F.lit(T0))
    assert merged == content()
    pay = {r["_event_id"]: r for r in lakehouse.read_silver(spark, root, "payments").collect()}
    assert pay["p1"]["status"] == "REFUNDED"
    assert {e: pay[e]["_reasons"] for e in ("p8", "p9", "p10")} == {
        "p8": ["dirty_step"], "p9": ["unmatched_step"], "p10": ["step_without_status"]}
    kept = {r["id"] for r in lakehouse.read_silver(spark, root, "orders").filter("_route = 'silver'").collect()}
    assert kept == {3, 5, 7}
    assert silver_rows(spark, root, "reviews", "review_id", "rating") == [(1, 4)]
    assert lakehouse.read_routed(spark, root, "reviews", silver.DEAD_LETTER).first()["_reasons"] == ["rating_out_of_range"]
    assert silver_rows(spark, root, "feedback", "feedback_id", F.col("type").isNull()) == [(3, True)]
    orders = {r["id"]: r["status"] for r in lakehouse.current_orders(spark, root).collect()}
    assert orders[5] == "DELIVERED" and orders[7] == "PENDING"
    product = lakehouse.current_products(spark, root).first()
    assert (product["id"], product["stock_quantity"], str(product["price"])) == (7, 3, "25.00")
    for tries in (1, 2, 3, 3):
        lakehouse.run_replay(spark, root, "products", F.lit(T0))
        again = lakehouse.dead_letter_states(spark, root, "products").collect()
        assert [(r["id"], r["_retry_count"], r["_state"]) for r in again] == [(8, tries, "retired" if tries == 3 else "waiting")]


def test_gold(spark, lake):
    root = lake[0]
    report = lakehouse.run_gold(spark, root, "gold_test")
    assert [tuple(r) for r in report.collect()] == [(2024, 3, 2, 100.0)]
    fact = spark.table("gold_test.fact_sales")
    assert len(fact.columns) == 30
    row = fact.filter("order_item_key = 10").first()
    assert (row["customer_name"], row["sku"], row["payment_method"], row["carrier"], row["delivery_days"]) == ("Anna Lee", "SKU-AB-1", "CREDIT_CARD", "DHL", 1.5)
    assert fact.filter("order_item_key = 11").first()["product_key"] is None
    assert spark.table("gold_test.dim_date").count() == 1


def test_silver_recipes_are_idempotent_under_redelivery(spark, lake):
    bronze = lakehouse.read_bronze(spark, lake[0], "erp_raw")
    once, twice = silver.orders(bronze), silver.orders(bronze.unionByName(bronze))
    assert sorted(map(str, once.collect())) == sorted(map(str, twice.collect()))


def test_quality_and_layer_counts(spark, lake):
    bronze = lakehouse.read_bronze(spark, lake[0], "erp_raw")
    out = {(r["entity"], r["route"]): r["row_count"] for r in quality_counts({"orders": silver.orders(bronze)}).collect()}
    assert out == {("orders", "silver"): 2, ("orders", "dead_letter"): 3}
    assert layer_counts({"b": bronze}).first()["row_count"] == 16


# --- streams ------------------------------------------------------------------------------------


def test_topic_stream_needs_a_source(spark):
    with pytest.raises(ValueError):
        read_topics(spark, "x")


def test_csv_drops_by_file_name(spark, tmp_path):
    head = "_source_system,_schema_version,_event_id,_event_type,_ingested_at,_quality_flag,_dirty_reason"
    (tmp_path / "products_bootstrap_1.csv").write_text(
        head + ",category_id,name,description,sku,price,cost,stock_quantity,brand,weight,is_active,created_at,updated_at\n"
        'wh,1,e1,product.created,2024-01-01,CLEAN,,3,Lamp,"two\nlines",SKU-1,9.50,1,4,acme,0.5,True,2024-01-01,2024-01-01\n')
    (tmp_path / "products_stock_update_1.csv").write_text(
        head + ",product_id,event,updated_at,new_stock,new_price\nwh,1,e2,product.stock_updated,2024-01-01,DIRTY,why,7,stock_update,2024-01-02,5,8.00\n")
    flows.drain(csv_drops.read_csv_drops(spark, str(tmp_path)), str(tmp_path / "out"), str(tmp_path / "ck"))
    got = {r["_event_id"]: r for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert (got["e1"]["description"], got["e1"]["sku"], got["e1"]["new_stock"]) == ("two\nlines", "SKU-1", None)
    assert (got["e2"]["new_stock"], got["e2"]["product_id"], got["e2"]["sku"]) == (5, 7, None)


def test_stream_split_runs_once_per_checkpoint(spark, tmp_path):
    spark.range(10).withColumn("_quality_flag", F.when(F.col("id") < 3, "DIRTY").when(F.col("id") < 9, "CLEAN")).write.parquet(str(tmp_path / "in"))
    stream = lambda: spark.readStream.schema("id bigint, _quality_flag string").parquet(str(tmp_path / "in"))
    for _ in range(2):
        flows.split_stream(stream(), flows.dlq_route("t"), str(tmp_path / "out"), str(tmp_path / "ck"))
    counts = spark.read.parquet(str(tmp_path / "out")).groupBy("_route").count().collect()
    assert {r[0]: r[1] for r in counts} == {"t": 7, "t.dlq": 3}


# --- plans --------------------------------------------------------------------------------------


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_topic_filter_prunes_folders(spark, lake):
    text = plan(parse_cdc(lakehouse.read_bronze(spark, lake[0], "erp_raw"), "erp.public.orders", schemas.CDC["orders"]))
    assert "PartitionFilters: [isnotnull(_source_topic" in text


def test_route_filter_prunes_folders(spark, lake):
    assert "PartitionFilters: [isnotnull(_route" in plan(lakehouse.read_routed(spark, lake[0], "orders", "silver"))


def test_latest_version_is_cut_before_the_shuffle(spark, lake):
    text = plan(silver.orders(lakehouse.read_bronze(spark, lake[0], "erp_raw")))
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")
    assert text.count("Exchange") == 1


def test_no_python_in_any_plan(spark, lake):
    tables = {n: lakehouse.read_routed(spark, lake[0], n, "silver") for n in ("orders", "customers", "order_items", "products", "payments", "shipping")}
    texts = [plan(df) for df in lakehouse.build_gold(tables).values()]
    texts.append(plan(cleaning.clean_table(spark.createDataFrame([("1", "x")], "id string, status string"),
                                           cleaning.CleaningConfig(categorical=["status"], dedup=["id"]))))
    assert not any("Python" in t or "CartesianProduct" in t for t in texts)


def test_fact_has_no_unchecked_broadcast(spark, lake, no_broadcast):
    tables = {n: lakehouse.read_routed(spark, lake[0], n, "silver") for n in ("orders", "customers", "order_items", "products", "payments", "shipping")}
    fact = lakehouse.build_gold(tables)["fact_sales"]
    assert fact.count() == 2 and "BroadcastHashJoin" not in plan(fact)


def test_payments_do_not_multiply_items(spark, lake):
    tables = {n: lakehouse.read_routed(spark, lake[0], n, "silver") for n in ("orders", "customers", "order_items", "products", "payments", "shipping")}
    second = tables["payments"].withColumn("id", F.lit(99).cast("bigint"))
    payments, shipping = gold.dim_payments(tables["payments"].unionByName(second)), gold.dim_shipping(tables["shipping"])
    fact = gold.fact_sales(tables["order_items"], tables["orders"], gold.dim_customers(tables["customers"]), gold.dim_products(tables["products"]), payments, shipping)
    assert fact.count() == 2
    fan = gold.fanout_rows(tables["order_items"], tables["orders"], payments, shipping)
    assert sorted(map(tuple, fan.collect())) == [(5, 2), (99, 2)]


def test_cleaning_is_idempotent(spark):
    df = spark.createDataFrame(
        [(i, " Pending ", f"${i}.50", "2024-01-02") for i in range(10)] + [(99, "N/A", "9999999", "25/06/2024")],
        "id int, status string, total_amount string, order_date string")
    config = cleaning.CleaningConfig(categorical=["status"], dates=["order_date"], numbers=["total_amount"], positive=["total_amount"],
                                     dedup=["total_amount"], order=["id"], outliers=["total_amount"])
    first = cleaning.clean_table(df, config)
    assert first.count() == 10 and first.filter("status = 'pending'").count() == 10
    text = first.select("id", "status", F.col("total_amount").cast("string").alias("total_amount"), F.date_format("order_date", "yyyy-MM-dd HH:mm:ss").alias("order_date"))
    assert sorted(map(tuple, cleaning.clean_table(text, config).collect())) == sorted(map(tuple, first.collect()))


def test_cleaning_drops_corrupt_rows(spark):
    df = spark.createDataFrame([(1, None), (2, "2,broken")], "id int, _corrupt_record string")
    assert [r[0] for r in cleaning.clean_table(df, cleaning.CleaningConfig()).collect()] == [1]


def test_bad_version_is_tagged(spark):
    bronze = to_bronze(spark.createDataFrame([message("erp.public.orders", order(1, 1, customer_id=None), 0)], schemas.MESSAGE))
    row = silver.orders(bronze).first()
    assert row["_route"] == "dead_letter" and row["_reasons"] == ["null_customer_id"] and row["_dirty_score"] == null_rule("x").weight
