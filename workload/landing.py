"""Sources, sinks and streams."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone import schemas, vocab
from siltstone.operators.references import classify_late_arrivals
from siltstone.operators.reports import newest_rows
from siltstone.operators.quality import with_orphan_flag, with_repeat_flag
from siltstone.plans.guarded import guarded_sql
from siltstone.session import scratch_folder
from siltstone.sources.bronze import read_topics, route_topic, to_bronze
from siltstone.sources.compaction import compact, read_packed
from siltstone.sources.csv_drops import read_csv_drops
from siltstone.sources.files import read_csv, read_json_array, read_or_empty, split_corrupt
from siltstone.sources.snapshots import merge_history, snapshot_manifest, tag_snapshot
from siltstone.sources.tables import ensure_database, list_tables, publish
from siltstone.sources.versions import VersionedTable
from siltstone.streaming.flows import (
    append_bronze, dedup_stream, dlq_route, drain, event_counts, late_arrival_stream, split_stream,
)
from siltstone.streaming.state import payment_desk_stream, status_stream
from workload.quality import STEP_KEY, STEP_OF
from workload.registry import TABLES, query

TOPIC_OF = {
    "view": "erp.public.orders",
    "click": "warehouse.events",
    "purchase": "payment.events",
    "signup": "payment.events.dlq",
    "error": "audit.warehouse.events",
}
TOPIC_SQL = "CASE event_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in TOPIC_OF.items()) + " END"


def as_messages(events: DataFrame) -> DataFrame:
    """Events in the shape of a message stream: four partitions per topic, dense ids as offsets."""
    return events.select(
        F.col("user_id").cast("string").cast("binary").alias("key"),
        F.to_json(F.struct("event_id", "user_id", "event_type", "value")).cast("binary").alias("value"),
        F.expr(TOPIC_SQL).alias("topic"),
        (F.col("event_id") % 4).cast("int").alias("partition"),
        F.floor(F.col("event_id") / 4).alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )


@query("topic_route", f"""
WITH t AS (SELECT {TOPIC_SQL} AS topic FROM events)
SELECT topic, CASE WHEN regexp_full_match(topic, 'erp\\.public\\..*') THEN 'erp_raw'
    WHEN topic = 'warehouse.events' THEN 'wh_raw' WHEN topic = 'warehouse.events.dlq' THEN 'wh_dlq'
    WHEN topic = 'payment.events' THEN 'pay_raw' WHEN topic = 'payment.events.dlq' THEN 'pay_dlq' END AS sink,
  count(*) AS messages FROM t GROUP BY ALL""")
def topic_route(t):
    topics = t.events.select(F.expr(TOPIC_SQL).alias("topic"))
    return topics.groupBy("topic").agg(F.count(F.lit(1)).alias("messages")).select(
        "topic", route_topic(F.col("topic")).alias("sink"), "messages"
    )


@query("topic_subscribe", f"""
SELECT {TOPIC_SQL} AS topic, count(*) AS messages FROM events WHERE event_type = 'purchase' GROUP BY ALL""")
def topic_subscribe(t):
    """The messages of matching topics, drained from a folder of message files."""
    path = scratch_folder(t.spark, "topics")
    as_messages(t.events).write.parquet(f"{path}/in")
    stream = read_topics(t.spark, vocab.TOPIC_ROUTES["pay_raw"], files=f"{path}/in")
    drain(stream.select("topic", "offset"), f"{path}/out", f"{path}/checkpoint")
    return t.spark.read.parquet(f"{path}/out").groupBy("topic").agg(F.count(F.lit(1)).alias("messages"))


BRONZE_DAILY = f"""
SELECT {TOPIC_SQL} AS _source_topic, CAST(ts AS DATE) AS ingest_date, count(*) AS messages,
  max(event_id // 4) AS last_offset FROM events GROUP BY ALL"""


def _daily(bronze):
    return bronze.groupBy("_source_topic", "ingest_date").agg(
        F.count(F.lit(1)).alias("messages"), F.max("_kafka_offset").alias("last_offset")
    )


@query("bronze_daily_counts", BRONZE_DAILY)
def bronze_daily_counts(t):
    return _daily(to_bronze(as_messages(t.events)))


@query("stream_bronze_landing", BRONZE_DAILY)
def stream_bronze_landing(t):
    """Landed twice from the same checkpoint: the second run finds nothing new."""
    path = scratch_folder(t.spark, "landing")
    for _ in range(2):
        append_bronze(to_bronze(as_messages(t.stream("events"))), f"{path}/bronze", f"{path}/checkpoint")
    return _daily(t.spark.read.schema(schemas.BRONZE).parquet(f"{path}/bronze"))


@query("stream_flag_split", """
SELECT CASE WHEN event_type = 'error' THEN 'warehouse.events.dlq' ELSE 'warehouse.events' END AS route,
  event_type, count(*) AS events FROM events GROUP BY ALL""")
def stream_flag_split(t):
    flag = F.when(F.col("event_type") == "error", vocab.DIRTY).when(F.col("event_type") != "signup", vocab.CLEAN)
    path = scratch_folder(t.spark, "split")
    split_stream(t.stream("events").withColumn("_quality_flag", flag), dlq_route("warehouse.events"),
                 f"{path}/events", f"{path}/checkpoint")
    rows = t.spark.read.parquet(f"{path}/events")
    return rows.groupBy(F.col("_route").alias("route"), "event_type").agg(F.count(F.lit(1)).alias("events"))


@query("stream_csv_drops", """
SELECT 'product.created' AS _event_type, count(*) AS rows, CAST(sum(CAST(p_retailprice AS DECIMAL(12,2))) AS DOUBLE) AS price_sum,
  CAST(NULL AS BIGINT) AS stock_sum FROM part
UNION ALL SELECT 'product.stock_updated', count(*), NULL, CAST(sum(p_size) AS BIGINT) FROM part""")
def stream_csv_drops(t):
    folder = scratch_folder(t.spark, "drops")
    meta = [
        F.lit("warehouse").alias("_source_system"), F.lit("1.0").alias("_schema_version"),
        F.concat(F.lit("e-"), F.col("p_partkey")).alias("_event_id"),
    ]
    tail = [F.lit("2024-01-01T00:00:00").alias("_ingested_at"), F.lit("CLEAN").alias("_quality_flag"), F.lit(None).cast("string").alias("_dirty_reason")]
    lifecycle = t.part.select(
        *meta, F.lit("product.created").alias("_event_type"), *tail, F.lit(1).alias("category_id"),
        F.col("p_name").alias("name"), F.concat(F.col("p_type"), F.lit("\n\"quoted\", "), F.col("p_name")).alias("description"),
        F.concat(F.lit("SKU-"), F.col("p_partkey")).alias("sku"), F.col("p_retailprice").cast("decimal(12,2)").alias("price"),
        F.lit("1").alias("cost"), F.col("p_size").alias("stock_quantity"), F.col("p_brand").alias("brand"),
        F.lit("1").alias("weight"), F.lit("true").alias("is_active"),
        F.lit("2024-01-01").alias("created_at"), F.lit("2024-01-01").alias("updated_at"),
    )
    stock = t.part.select(
        *meta, F.lit("product.stock_updated").alias("_event_type"), *tail, F.col("p_partkey").alias("product_id"),
        F.lit("stock_update").alias("event"), F.lit("2024-01-02").alias("updated_at"),
        F.col("p_size").alias("new_stock"), F.col("p_retailprice").cast("decimal(12,2)").alias("new_price"),
    )
    writer = dict(header=True, escape='"', mode="overwrite")
    lifecycle.write.csv(f"{folder}/in/layout=lifecycle", **writer)
    stock.write.csv(f"{folder}/in/layout=stock", **writer)
    # Spark names its own files, so here the layouts are told apart by folder.
    both = read_csv_drops(t.spark, f"{folder}/in/layout=lifecycle", lifecycle="*.csv", stock="none").unionByName(
        read_csv_drops(t.spark, f"{folder}/in/layout=stock", lifecycle="none", stock="*.csv")
    )
    drain(both, f"{folder}/out", f"{folder}/checkpoint")
    return t.spark.read.parquet(f"{folder}/out").groupBy("_event_type").agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(F.col("price").cast("decimal(12,2)")).cast("double").alias("price_sum"),
        F.sum("new_stock").alias("stock_sum"),
    )


@query("stream_dedup", "SELECT event_type, count(*) AS events, CAST(sum(event_id) AS BIGINT) AS id_sum FROM events GROUP BY 1")
def stream_dedup(t):
    """Every event delivered twice, one copy kept."""
    path = scratch_folder(t.spark, "dedup")
    twice = t.stream("events").withColumn("ts", F.col("ts").cast("timestamp")).withColumn(
        "_copy", F.explode(F.array(F.lit(1), F.lit(2)))
    )
    drain(dedup_stream(twice, ["event_id"], "ts").drop("_copy"), f"{path}/out", f"{path}/checkpoint")
    return t.spark.read.parquet(f"{path}/out").groupBy("event_type").agg(
        F.count(F.lit(1)).alias("events"), F.sum("event_id").alias("id_sum")
    )


@query("stream_event_counts", """
WITH w AS (SELECT date_trunc('hour', ts) AS window_start, event_type, count(*) AS events FROM events GROUP BY ALL)
SELECT * FROM w WHERE window_start + INTERVAL 1 HOUR <= (SELECT date_trunc('millisecond', max(ts)) - INTERVAL 10 MINUTE FROM events)""")
def stream_event_counts(t):
    path = scratch_folder(t.spark, "windows")
    stream = t.stream("events").withColumn("ts", F.col("ts").cast("timestamp"))
    drain(event_counts(stream, "ts", ["event_type"]), f"{path}/out", f"{path}/checkpoint")
    return t.spark.read.parquet(f"{path}/out").withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


# A view creates the order of its own id; a purchase pays the order at the head of its run of seven
# events, which exists where that event is a view.
ORDER_REF = "event_id - event_id % 7"


@query("stream_interval_join", f"""
WITH p AS (SELECT event_id AS payment_id, ts AS paid_at, {ORDER_REF} AS order_id FROM events WHERE event_type = 'purchase'),
o AS (SELECT event_id AS order_event, ts AS ordered_at, event_id AS order_id FROM events WHERE event_type = 'view'),
j AS (SELECT p.payment_id, p.order_id, p.paid_at, o.order_event FROM p LEFT JOIN o ON p.order_id = o.order_id
  AND p.paid_at BETWEEN o.ordered_at - INTERVAL 10 MINUTE AND o.ordered_at + INTERVAL 10 MINUTE),
w AS (SELECT least((SELECT max(paid_at) FROM p), (SELECT max(ordered_at) FROM o)) - INTERVAL 10 MINUTE AS wm)
SELECT payment_id, order_id, order_event, CASE WHEN order_event IS NOT NULL THEN 'joined'
  WHEN paid_at + INTERVAL 10 MINUTE < wm THEN 'dead_letter' ELSE 'waiting' END AS bucket FROM j, w""")
def stream_interval_join(t):
    """Payments without an order in the band come out once the watermark has passed; the rest wait in the state."""
    path = scratch_folder(t.spark, "band")
    events = t.stream("events").withColumn("ts", F.col("ts").cast("timestamp"))
    paid = events.filter(F.col("event_type") == "purchase").select(
        F.col("event_id").alias("payment_id"), F.col("ts").alias("paid_at"), F.expr(ORDER_REF).alias("order_id"))
    made = events.filter(F.col("event_type") == "view").select(
        F.col("event_id").alias("order_event"), F.col("ts").alias("ordered_at"), F.col("event_id").alias("order_id"))
    joined = late_arrival_stream(paid, made, "order_id", "paid_at", "ordered_at", minutes=10)
    drain(joined, f"{path}/out", f"{path}/checkpoint")
    out = t.spark.read.parquet(f"{path}/out").select(
        "payment_id", "order_id", "order_event", F.when(F.col("order_event").isNull(), "dead_letter").otherwise("joined").alias("bucket"))
    every = t.events.filter(F.col("event_type") == "purchase").select(
        F.col("event_id").alias("payment_id"), F.expr(ORDER_REF).alias("order_id"), F.lit(None).cast("bigint").alias("order_event"), F.lit("waiting").alias("bucket"))
    return out.unionByName(every.join(out, "payment_id", "left_anti").select(*out.columns))


@query("gold_partition_counts", """
SELECT CAST(year(o_orderdate) AS INTEGER) AS order_year, CAST(month(o_orderdate) AS INTEGER) AS order_month, count(*) AS rows
FROM orders GROUP BY ALL""")
def gold_partition_counts(t):
    folder = scratch_folder(t.spark, "gold")
    ensure_database(t.spark, "siltstone_check", f"{folder}/db")
    dated = t.orders.withColumns({"order_year": F.year("o_orderdate"), "order_month": F.month("o_orderdate")})
    table = publish(dated, "siltstone_check", f"orders_{folder[-8:]}", f"{folder}/orders", ["order_year", "order_month"])
    return table.groupBy("order_year", "order_month").agg(F.count(F.lit(1)).alias("rows"))


@query("corrupt_split", """
WITH j AS (SELECT *, total_amount IS NOT NULL AND total_amount <> 'NaN' AND TRY_CAST(total_amount AS DOUBLE) IS NULL AS corrupt FROM dirty_orders)
SELECT corrupt, count(*) AS rows FROM j GROUP BY 1""", uses=("dirty_orders",))
def corrupt_split(t):
    path = scratch_folder(t.spark, "csv")
    t.dirty_orders.write.csv(path, header=True, escape='"')
    schema = "id bigint, customer_id bigint, status string, total_amount double, order_date string, category string, _quality_flag string"
    clean, corrupt = split_corrupt(read_csv(t.spark, path, schema, multiline=False))
    sides = [df.select(F.lit(flag).alias("corrupt"), "id") for df, flag in ((clean, False), (corrupt, True))]
    return sides[0].unionByName(sides[1]).groupBy("corrupt").agg(F.count("id").alias("rows"))


@query("snapshot_tagged", """
SELECT *, 'historical' AS _load_type, 'erp' AS _source_system, 'customer' AS _table_name,
  TIMESTAMP '2024-02-01 00:00:00' AS _loaded_at FROM customer""")
def snapshot_tagged(t):
    return tag_snapshot(t.customer, "erp", "customer", F.expr("TIMESTAMP_NTZ '2024-02-01 00:00:00'"))


@query("snapshot_manifest", " UNION ALL ".join(
    f"SELECT '{n}' AS table_name, count(*) AS row_count, TIMESTAMP '2024-02-01 00:00:00' AS snapshot_time FROM {n}" for n in TABLES))
def manifest(t):
    return snapshot_manifest({n: getattr(t, n) for n in TABLES}, F.expr("TIMESTAMP_NTZ '2024-02-01 00:00:00'"))


@query("merge_history", """
WITH h AS (SELECT o_orderkey + i.n AS id, o_custkey AS customer_id, 'archived' AS status, CAST(o_totalprice AS DECIMAL(12,2)) AS total_amount
  FROM orders, (SELECT unnest([0, 1000000000000]) AS n) i),
c AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY __source_ts_ms DESC) AS rn FROM cdc_orders),
n AS (SELECT * FROM c WHERE rn = 1)
SELECT h.id, h.customer_id, coalesce(n.status, h.status) AS status, CAST(h.total_amount AS DOUBLE) AS total_amount,
  CASE WHEN n.id IS NULL THEN 'historical' ELSE 'cdc' END AS _load_type
FROM h LEFT JOIN n ON h.id = n.id WHERE n.__op IS NULL OR n.__op <> 'd'""", uses=("cdc_orders",))
def merged(t):
    """The log repeats creations that the snapshot holds and adds what came after; older rows are in the snapshot only."""
    history = t.orders.withColumn("n", F.explode(F.array(F.lit(0), F.lit(1000000000000)))).select(
        (F.col("o_orderkey") + F.col("n")).alias("id"), F.col("o_custkey").alias("customer_id"), F.lit("archived").alias("status"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("total_amount"),
    )
    changes = t.cdc_orders.drop("order_date")
    return merge_history(history, changes, ["id"]).select(
        "id", "customer_id", "status", F.col("total_amount").cast("double").alias("total_amount"), "_load_type"
    )


@query("latest_orders", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate FROM orders
ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 3""")
def latest_orders(t):
    rows = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    return newest_rows(rows, ["o_orderdate", "o_orderkey"], 3)


GUARDED = "SELECT o_orderpriority, count(*) AS updated_rows, max(o_orderkey) AS last_key FROM orders GROUP BY o_orderpriority"


@query("guarded_sql", GUARDED)
def guarded(t):
    view = f"orders_{uuid.uuid4().hex}"
    t.orders.createOrReplaceTempView(view)
    try:
        return guarded_sql(t.spark, GUARDED.replace("FROM orders", f"FROM {view}") + ";", tables=[view])
    finally:
        t.spark.catalog.dropTempView(view)


@query("csv_multiline", """
SELECT doc_id, CASE WHEN doc_id % 10 = 3 THEN NULL ELSE md5(CASE doc_id % 10 WHEN 1 THEN '' WHEN 2 THEN '  ' ELSE text END) END AS digest FROM documents""")
def csv_multiline(t):
    """Texts with line breaks, empty ones, blank ones and NULLs written as CSV and read back whole."""
    path = scratch_folder(t.spark, "csv")
    last = F.col("doc_id") % 10
    text = F.when(last == 1, "").when(last == 2, "  ").when(last != 3, F.col("text"))
    t.documents.select("doc_id", text.alias("text")).write.csv(path, header=True, escape='"', quoteAll=True, nullValue="\\N", emptyValue="",
                                                                      ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    clean, _ = split_corrupt(read_csv(t.spark, path, "doc_id bigint, text string", null="\\N"))
    return clean.select("doc_id", F.md5("text").alias("digest"))


@query("bronze_compacted", BRONZE_DAILY)
def bronze_compacted(t):
    """Messages landed in four parts as small files, packed after the second and the third; the fourth is still in landing files."""
    path = scratch_folder(t.spark, "packed")
    landing, packed = f"{path}/bronze", f"{path}/packed"
    for part in range(4):
        as_messages(t.events.filter(F.least(F.floor(F.col("event_id") * 4 / F.lit(t.events.count())), F.lit(3)) == part)).repartition(4).write.mode("append").parquet(f"{path}/in")
        messages = read_topics(t.spark, ".*", files=f"{path}/in")
        append_bronze(to_bronze(messages), landing, f"{path}/checkpoint")
        if part in (1, 2):
            compact(t.spark, landing, packed, target=1 << 20)
    return _daily(read_packed(t.spark, landing, packed))


PRICE = "CAST(o_totalprice AS DECIMAL(18,2))"


@query("table_versions", f"""
SELECT 1 AS version, count(*) AS rows, CAST(sum({PRICE}) AS DOUBLE) AS total FROM orders WHERE o_orderstatus = 'O'
UNION ALL SELECT 2, count(*), CAST(sum({PRICE}) AS DOUBLE) FROM orders
UNION ALL SELECT 3, count(*), CAST(sum(CASE WHEN o_orderkey % 8 IN (2, 5) THEN 2 ELSE 1 END * {PRICE}) AS DOUBLE) FROM orders WHERE o_orderkey % 8 <> 7""")
def table_versions(t):
    """A table rewritten twice, the second time in three of its eight parts only, one of which is left without rows; and read
    in each of its versions."""
    table = VersionedTable(t.spark, f"{scratch_folder(t.spark, 'versions')}/orders")
    rows = t.orders.withColumns({"part": (F.col("o_orderkey") % 8).cast("int"), "price": F.col("o_totalprice").cast("decimal(18,2)")})
    table.overwrite(rows.filter("o_orderstatus = 'O'"))
    table.replace(rows, ["part"])
    # Reads the version that it replaces parts of.
    doubled = table.read(only=lambda at: at["part"] in (2, 5)).withColumn("price", (F.col("price") * 2).cast("decimal(18,2)"))
    table.replace(doubled, ["part"], gone=lambda at: at["part"] in (2, 5, 7))
    counts = [table.read(version=v).agg(F.lit(v).alias("version"), F.count(F.lit(1)).alias("rows"), F.sum("price").cast("double").alias("total"))
              for v in table.versions()]
    return reduce(DataFrame.unionByName, counts)


@query("json_array", "SELECT CAST(p_partkey AS BIGINT) AS id, p_name AS name, p_size AS size FROM part")
def json_array(t):
    """Files of one array each, for every thousand parts, read back."""
    path = scratch_folder(t.spark, "json")
    arrays = t.part.groupBy(F.floor(F.col("p_partkey") / 1000).alias("batch")).agg(F.to_json(F.collect_list(F.struct(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.col("p_size").alias("size")))).alias("value"))
    arrays.write.partitionBy("batch").text(path)
    return read_json_array(t.spark, f"{path}/batch=*", "id bigint, name string, size int")


@query("read_or_empty", "SELECT 'missing' AS place, 0 AS rows UNION ALL SELECT 'written', count(*) FROM part")
def read_or_empty_counts(t):
    path, shape = scratch_folder(t.spark, "parts"), "p_partkey bigint"
    t.part.select(F.col("p_partkey").cast("bigint")).write.parquet(f"{path}/written")
    counts = [read_or_empty(t.spark, f"{path}/{p}", shape).agg(F.lit(p).alias("place"), F.count(F.lit(1)).alias("rows")) for p in ("missing", "written")]
    return counts[0].unionByName(counts[1])


@query("list_tables", "SELECT 'parts' AS table_name, 'EXTERNAL' AS table_type, count(*) AS rows FROM part")
def listed(t):
    folder = scratch_folder(t.spark, "listed")
    database = f"siltstone_{folder[-12:]}"
    ensure_database(t.spark, database, f"{folder}/db")
    rows = publish(t.part, database, "parts", f"{folder}/parts").agg(F.lit("parts").alias("table_name"), F.count(F.lit(1)).alias("rows"))
    return list_tables(t.spark, database).join(rows, "table_name")


@query("duplicate_txn", "SELECT event_id, count(*) OVER (PARTITION BY txn) > 1 AS duplicate_txn_id FROM gateway WHERE kind = 'payment.created'", uses=("gateway",))
def duplicate_txn(t):
    made = t.gateway.filter(F.col("kind") == "payment.created")
    return with_repeat_flag(made, ["txn"], "duplicate_txn_id").select("event_id", "duplicate_txn_id")


@query("mismatched_order_ref", """
SELECT event_id, NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = user_id) AS mismatched_order_ref FROM gateway""", uses=("gateway",))
def mismatched_order_ref(t):
    return with_orphan_flag(t.gateway, "user_id", t.orders, "o_orderkey", "mismatched_order_ref").select("event_id", "mismatched_order_ref")


@query("stream_status_fold", f"""
WITH s AS (SELECT event_id, ts, {STEP_KEY} AS user_id, {STEP_OF} AS status_to FROM events),
f AS (SELECT user_id, arg_max(status_to, (ts, event_id)) FILTER (WHERE status_to IS NOT NULL) AS status, min(ts) FILTER (WHERE status_to = 'picked_up') AS shipped_at,
  min(ts) FILTER (WHERE status_to = 'delivered') AS delivered_at FROM s GROUP BY 1)
SELECT c_custkey AS user_id, coalesce(f.status, 'none') AS status, shipped_at, delivered_at FROM customer LEFT JOIN f ON c_custkey = user_id""")
def stream_status_fold(t):
    """The status of each key as a state machine on the stream has it, the same as the fold of the whole table."""
    return _moved(t, "state", lambda rows: t.customer.select(F.col("c_custkey").alias("user_id")).join(
        rows.filter(F.col("user_id").isNotNull()).groupBy("user_id").agg(F.max_by(F.struct("status_to", "shipped_at", "delivered_at"), "changes").alias("s")), "user_id", "left").select(
        "user_id", F.coalesce("s.status_to", F.lit("none")).alias("status"), *[F.col(f"s.{c}").cast("timestamp_ntz").alias(c) for c in ("shipped_at", "delivered_at")]))


@query("stream_illegal_steps", f"""
WITH s AS (SELECT event_id, ts, {STEP_KEY} AS user_id, {STEP_OF} AS status_to FROM events),
l AS (SELECT *, lag(status_to) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM s)
SELECT event_id, user_id, prev AS status_from, status_to FROM l WHERE prev IS NOT NULL AND prev <> status_to
  AND NOT ((prev = 'pending' AND status_to = 'picked_up') OR (prev = 'picked_up' AND status_to = 'in_transit')
  OR (prev = 'in_transit' AND status_to = 'out_for_delivery') OR (prev = 'out_for_delivery' AND status_to = 'delivered'))""")
def stream_illegal_steps(t):
    """Steps that the state machine turns down as they come."""
    return _moved(t, "illegal", lambda rows: rows.select("event_id", "user_id", "status_from", "status_to"))


def _moved(t, kind, finish):
    path = scratch_folder(t.spark, "moved")
    events = t.stream("events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), F.expr(STEP_KEY).alias("user_id"), F.expr(STEP_OF).alias("status_to"))
    drain(status_stream(events, "user_id", "ts", "event_id"), f"{path}/out", f"{path}/checkpoint")
    return finish(t.spark.read.parquet(f"{path}/out").filter(F.col("kind") == kind))


@query("stream_payment_desk", f"""
WITH p AS (SELECT event_id AS payment_id, ts AS paid_at, {ORDER_REF} AS order_id FROM events WHERE event_type = 'purchase'),
o AS (SELECT event_id AS order_id, ts AS ordered_at FROM events WHERE event_type = 'view'),
w AS (SELECT greatest((SELECT max(paid_at) FROM p), (SELECT max(ordered_at) FROM o)) - INTERVAL 10 MINUTE AS wm)
SELECT payment_id, order_id, CASE WHEN ordered_at IS NOT NULL AND abs(epoch_us(paid_at) - epoch_us(ordered_at)) <= 600000000 THEN 'joined'
  WHEN ordered_at IS NOT NULL THEN 'late' WHEN paid_at + INTERVAL 10 MINUTE <= wm THEN 'no_order' ELSE 'waiting' END AS result
FROM p LEFT JOIN o USING (order_id), w""")
def stream_payment_desk(t):
    """Payments with the reason for each: matched, late against their order, or without any; those that wait are not told yet."""
    path = scratch_folder(t.spark, "desk")
    events = t.stream("events").withColumn("ts", F.col("ts").cast("timestamp"))
    paid = events.filter(F.col("event_type") == "purchase").select(F.col("event_id").alias("payment_id"), F.col("ts").alias("paid_at"), F.expr(ORDER_REF).alias("order_id"))
    made = events.filter(F.col("event_type") == "view").select(F.col("ts").alias("ordered_at"), F.col("event_id").alias("order_id"))
    drain(payment_desk_stream(paid, made, "order_id", "payment_id", "paid_at", "ordered_at", minutes=10), f"{path}/out", f"{path}/checkpoint")
    out = t.spark.read.parquet(f"{path}/out").select("payment_id", "order_id", "result")
    every = t.events.filter(F.col("event_type") == "purchase").select(
        F.col("event_id").alias("payment_id"), F.expr(ORDER_REF).alias("order_id"), F.lit("waiting").alias("result"))
    return out.unionByName(every.join(out, "payment_id", "left_anti").select(*out.columns))


# `late_arrival` in batch form shares the order reference above.
@query("late_arrival", f"""
WITH p AS (SELECT event_id AS payment_id, ts AS paid_at, {ORDER_REF} AS order_id FROM events WHERE event_type = 'purchase'),
o AS (SELECT event_id AS order_id, ts AS ordered_at FROM events WHERE event_type = 'view'),
j AS (SELECT p.*, o.ordered_at, (epoch_us(p.paid_at) - epoch_us(o.ordered_at)) / 1e6 AS lag FROM p LEFT JOIN o USING (order_id))
SELECT payment_id, order_id, lag AS _join_lag_sec,
  CASE WHEN ordered_at IS NULL THEN 'waiting' WHEN abs(lag) <= 10 * 60 THEN 'joined' ELSE 'late' END AS _join_result,
  CASE WHEN ordered_at IS NOT NULL AND abs(lag) > 10 * 60 THEN concat('payment ', CAST(CAST(abs(lag) AS DECIMAL(20,3)) AS VARCHAR), 's ',
    CASE WHEN lag < 0 THEN 'before' ELSE 'after' END, ' its order, allowed 10 min') END AS _dlq_reason
FROM j""")
def late_arrival(t):
    paid = t.events.filter(F.col("event_type") == "purchase").select(
        F.col("event_id").alias("payment_id"), F.col("ts").alias("paid_at"), F.expr(ORDER_REF).alias("order_id"))
    made = t.events.filter(F.col("event_type") == "view").select(
        F.col("event_id").alias("order_id"), F.col("ts").alias("ordered_at"))
    return classify_late_arrivals(paid, made, minutes=10).select(
        "payment_id", "order_id", "_join_lag_sec", "_join_result", "_dlq_reason"
    )
