"""Keys, duplicates, references and gaps."""

from __future__ import annotations

from pyspark.sql import functions as F

from siltstone.functions.keys import surrogate_key
from siltstone.functions.times import elapsed_days
from siltstone.operators.hierarchy import hierarchy
from siltstone.operators import dedup, references
from siltstone.operators.skew import skew_join
from workload.registry import query


@query("surrogate_key", """
SELECT o_orderkey, md5('erp:' || o_orderkey) AS erp_key, md5('payment_gw:' || o_orderkey) AS gateway_key,
  md5('warehouse:' || o_orderkey) AS warehouse_key FROM orders""")
def surrogate(t):
    i = F.col("o_orderkey")
    return t.orders.select("o_orderkey", *[
        surrogate_key(s, i).alias(n)
        for s, n in (("erp", "erp_key"), ("payment_gw", "gateway_key"), ("warehouse", "warehouse_key"))
    ])


@query("surrogate_join", """
SELECT md5('erp:' || c_custkey) AS customer_sk, o_orderkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey""")
def surrogate_join(t):
    """Two systems meet on the key of the system that owns the id."""
    orders = t.orders.select("o_orderkey", surrogate_key("erp", F.col("o_custkey")).alias("customer_sk"))
    customers = t.customer.select("c_name", surrogate_key("erp", F.col("c_custkey")).alias("customer_sk"))
    return skew_join(orders, customers, ["customer_sk"], "inner").select("customer_sk", "o_orderkey", "c_name")


@query("dup_exact", """
SELECT min(doc_id) AS first_id, count(*) AS copies FROM documents GROUP BY text HAVING count(*) > 1""")
def dup_exact(t):
    return dedup.repeated_text(t.documents, "text", "doc_id")


@query("dup_count", """
SELECT (SELECT count(*) FROM dirty_orders) AS total_rows, count(*) AS distinct_rows,
  (SELECT count(*) FROM dirty_orders) - count(*) AS duplicate_rows FROM (SELECT DISTINCT * FROM dirty_orders) d""", uses=("dirty_orders",))
def dup_count(t):
    return dedup.duplicate_count(t.dirty_orders)


@query("dedup_exact", "SELECT DISTINCT * FROM dirty_orders", uses=("dirty_orders",))
def dedup_exact(t):
    return dedup.dedup_exact(t.dirty_orders)


@query("cdc_latest", """
SELECT id, status, __op, __source_ts_ms FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY __source_ts_ms DESC) AS rn
FROM cdc_orders) c WHERE rn = 1""", uses=("cdc_orders",))
def cdc_latest(t):
    return dedup.latest_per_key(t.cdc_orders, ["id"], "__source_ts_ms").select("id", "status", "__op", "__source_ts_ms")


@query("dedup_events", """
WITH g AS (SELECT event_id, ts, CASE WHEN event_type <> 'error' THEN txn END AS transaction_id FROM gateway),
e AS (SELECT * FROM g UNION ALL SELECT * FROM g UNION ALL SELECT event_id, ts + INTERVAL 1 SECOND, concat(transaction_id, '-again') FROM g WHERE event_id % 9 = 0),
f AS (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY ts, transaction_id) AS delivery FROM e)
SELECT event_id, transaction_id, ts AS seen_at FROM (SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY ts, event_id) AS rn
FROM f WHERE delivery = 1 AND transaction_id IS NOT NULL) r WHERE rn = 1""", uses=("gateway",))
def dedup_events(t):
    """Every event redelivered, some under another transaction, then one event per transaction; events without one are dropped."""
    events = t.gateway.select(
        "event_id", F.when(F.col("event_type") != "error", F.col("txn")).alias("transaction_id"), F.col("ts").alias("seen_at"))
    again = events.filter(F.col("event_id") % 9 == 0).withColumns({
        "transaction_id": F.concat("transaction_id", F.lit("-again")), "seen_at": F.col("seen_at") + F.expr("INTERVAL 1 SECOND")})
    return dedup.dedup_events(events.unionByName(events).unionByName(again), "event_id", "transaction_id", "seen_at")


LINE_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_discount", "l_tax"]


@query("dedup_business", f"""
SELECT * EXCLUDE rn FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {', '.join(LINE_ORDER)}) AS rn
FROM lineitem) l WHERE rn = 1""")
def dedup_business(t):
    return dedup.dedup_by(t.lineitem, ["l_orderkey", "l_linenumber"], [F.col(c).asc_nulls_last() for c in LINE_ORDER])


@query("flag_dups", f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {', '.join(LINE_ORDER)}) > 1 AS is_repeat
FROM lineitem""")
def flag_dups(t):
    rows = dedup.flag_repeats(t.lineitem, ["l_orderkey", "l_linenumber"], LINE_ORDER)
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "is_repeat")


@query("flag_exact_dups", """
SELECT id, row_number() OVER (PARTITION BY id ORDER BY status) > 1 AS is_repeat FROM dirty_orders""", uses=("dirty_orders",))
def flag_exact_dups(t):
    """Of rows that are equal in every column, one is the first."""
    return dedup.flag_repeats(t.dirty_orders, ["id"], t.dirty_orders.columns).select("id", "is_repeat")


@query("pk_violations", """
SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY ALL HAVING count(*) > 1""")
def pk_violations(t):
    return dedup.key_violations(t.lineitem, ["l_orderkey", "l_linenumber"])


@query("near_dups", """
WITH n AS (SELECT *, CAST(replace(replace(total_amount, '$', ''), 'USD', '') AS DECIMAL(12,3)) AS amount FROM near_orders)
SELECT b.id, b.customer_id, b.total_amount, min(a.id) AS twin_id, CAST(count(a.id) AS BIGINT) AS near_rows
FROM n b JOIN n a ON a.customer_id = b.customer_id AND a.order_date = b.order_date
  AND lower(trim(a.status)) = lower(trim(b.status)) AND abs(a.amount - b.amount) <= 0.01
GROUP BY ALL HAVING min(a.id) < b.id""", uses=("near_orders",))
def near_dups(t):
    found = dedup.near_duplicates(t.near_orders, "id", ["customer_id", "order_date"], ["status"], "total_amount")
    return found.select("id", "customer_id", "total_amount", "twin_id", "near_rows")


# --- references ---------------------------------------------------------------------------------


@query("orphans", """
SELECT id, customer_id, total_amount FROM dirty_orders WHERE customer_id IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = customer_id)""", uses=("dirty_orders",))
def orphans(t):
    return references.orphans(t.dirty_orders, "customer_id", t.customer, "c_custkey").select("id", "customer_id", "total_amount")


@query("referenced_only", """
SELECT id, customer_id, total_amount FROM dirty_orders WHERE EXISTS (SELECT 1 FROM customer WHERE c_custkey = customer_id)""", uses=("dirty_orders",))
def referenced_only(t):
    return references.keep_referenced(t.dirty_orders, "customer_id", t.customer, "c_custkey").select("id", "customer_id", "total_amount")


EDGES = (
    ("dirty_orders", "customer_id", "customer", "c_custkey"),
    ("orders", "o_custkey", "customer", "c_custkey"),
    ("lineitem", "l_orderkey", "orders", "o_orderkey"),
    ("lineitem", "l_partkey", "part", "p_partkey"),
    ("lineitem", "l_suppkey", "supplier", "s_suppkey"),
    ("customer", "c_nationkey", "nation", "n_nationkey"),
    ("supplier", "s_nationkey", "nation", "n_nationkey"),
    ("nation", "n_regionkey", "region", "r_regionkey"),
    ("labels", "doc_id", "documents", "doc_id"),
)


@query("fk_report", " UNION ALL ".join(f"""
SELECT '{c}' AS child_table, '{fk}' AS fk, '{p}' AS parent_table, count(*) AS child_rows,
  count(*) FILTER (WHERE c.{fk} IS NULL) AS null_refs,
  count(*) FILTER (WHERE c.{fk} IS NOT NULL AND p.k IS NULL) AS orphans
FROM {c} c LEFT JOIN (SELECT DISTINCT {pk} AS k FROM {p}) p ON c.{fk} = p.k""" for c, fk, p, pk in EDGES), uses=("dirty_orders",))
def fk_report(t):
    names = {n for c, _, p, _ in EDGES for n in (c, p)}
    return references.fk_report({n: getattr(t, n) for n in names}, EDGES)


# Some orders have no status; they are neither cancelled nor returned.
STATUS = "CASE WHEN o_orderkey % 16 = 5 THEN NULL WHEN o_orderstatus = 'F' THEN 'delivered' WHEN o_orderstatus = 'O' THEN 'pending' ELSE 'cancelled' END"


def _orders(t):
    return t.orders.select(F.col("o_orderkey").alias("order_id"), "o_custkey", F.expr(STATUS).alias("status"))


def _lines(t):
    return t.lineitem.withColumnsRenamed({"l_orderkey": "order_id", "l_partkey": "product_id"})


@query("gap_unpaid", f"""
SELECT o_orderkey AS order_id, o_custkey, {STATUS} AS status FROM orders WHERE (o_orderstatus <> 'P' OR o_orderkey % 16 = 5)
  AND NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_linenumber > 1)""")
def gap_unpaid(t):
    return references.unpaid_orders(_orders(t), _lines(t).filter(F.col("l_linenumber") > 1))


PAID = "CASE l_returnflag WHEN 'A' THEN 'completed' WHEN 'N' THEN 'pending' ELSE 'failed' END"


@query("gap_unshipped", f"""
SELECT o_orderkey AS order_id, o_custkey, {STATUS} AS status FROM orders o WHERE (o_orderstatus <> 'P' OR o_orderkey % 16 = 5)
  AND EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'A')
  AND NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_linestatus = 'F')""")
def gap_unshipped(t):
    payments = _lines(t).withColumn("payment_status", F.expr(PAID))
    return references.unshipped_paid_orders(_orders(t), payments, _lines(t).filter(F.col("l_linestatus") == "F"))


@query("gap_unreviewed", """
SELECT DISTINCT l_orderkey AS order_id, l_partkey AS product_id FROM lineitem l
WHERE EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderstatus = 'F' AND o_orderkey % 16 <> 5)
  AND NOT EXISTS (SELECT 1 FROM lineitem r WHERE r.l_returnflag = 'R' AND r.l_orderkey = l.l_orderkey AND r.l_partkey = l.l_partkey)""")
def gap_unreviewed(t):
    reviews = _lines(t).filter(F.col("l_returnflag") == "R")
    return references.unreviewed_items(_orders(t), _lines(t), reviews)


@query("orders_without_items", """
SELECT o_orderkey AS order_id, o_totalprice FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)""")
def orders_without_items(t):
    heads = t.orders.select(F.col("o_orderkey").alias("order_id"), "o_totalprice")
    return references.orders_without_items(heads, _lines(t))


@query("amount_mismatch", """
WITH s AS (SELECT l_orderkey, coalesce(sum(CASE WHEN l_partkey % 40 <> 3 THEN CAST(l_extendedprice AS DECIMAL(12,2)) END), 0) AS paid,
  count(*) FILTER (WHERE l_partkey % 40 = 3) AS unreadable FROM lineitem GROUP BY 1),
j AS (SELECT o_orderkey AS order_id, CAST(o_totalprice AS DECIMAL(12,2)) AS due, paid, unreadable FROM orders JOIN s ON o_orderkey = l_orderkey)
SELECT order_id, CAST(due AS DOUBLE) AS expected_amount, CAST(paid AS DOUBLE) AS paid_amount, CAST(paid - due AS DOUBLE) AS delta,
  CASE WHEN due <> 0 THEN CAST(paid - due AS DOUBLE) / CAST(due AS DOUBLE) END AS relative_delta, unreadable
FROM j WHERE abs(paid - due) > 0.01 OR unreadable > 0""")
def amount_mismatch(t):
    """Payments as text, some of which is no number."""
    paid = F.when(F.col("l_partkey") % 40 == 3, "abc").otherwise(F.col("l_extendedprice").cast("decimal(12,2)").cast("string"))
    return references.amount_mismatch(
        t.orders.withColumnRenamed("o_orderkey", "order_id"), "order_id", "o_totalprice",
        t.lineitem.withColumn("paid", paid), "l_orderkey", "paid")


@query("delivery_days", """
SELECT l_orderkey, l_linenumber, l_partkey, (epoch(l_shipdate) - epoch(o_orderdate)) / 86400.0 AS days
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def delivery_days(t):
    heads = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    joined = skew_join(t.lineitem, heads, ["l_orderkey"], "inner")
    return joined.select(
        "l_orderkey", "l_linenumber", "l_partkey", elapsed_days(F.col("o_orderdate"), F.col("l_shipdate")).alias("days"))


# Parts under the part of a third of their number, so that the chains are as long as its logarithm; some references point nowhere, some
# pairs of parts are each other's parents, and one part is its own.
PARENT = """CASE WHEN p_partkey % 50 = 7 THEN p_partkey + 1000000000 WHEN p_partkey % 101 = 5 THEN p_partkey + 1 WHEN p_partkey % 101 = 6 THEN p_partkey - 1
  WHEN p_partkey = 44 THEN 44 WHEN p_partkey < 3 THEN NULL ELSE CAST(floor(p_partkey / 3) AS BIGINT) END"""


@query("category_tree", f"""
WITH RECURSIVE c AS (SELECT p_partkey AS id, {PARENT} AS parent FROM part),
u AS (SELECT id, parent AS above FROM c WHERE parent IS NOT NULL UNION SELECT u.id, c.parent FROM u JOIN c ON c.id = u.above WHERE c.parent IS NOT NULL),
y AS (SELECT id FROM u WHERE above = id),
x AS (SELECT u.id, bool_or(y.id IS NOT NULL) AS into_cycle, bool_or(k.id IS NULL) AS lost, count(k.id) AS depth,
    max(CASE WHEN k.id IS NOT NULL AND (k.parent IS NULL OR k.parent NOT IN (SELECT id FROM c)) THEN k.id END) AS root
  FROM u LEFT JOIN c k ON k.id = u.above LEFT JOIN y ON y.id = u.above GROUP BY 1)
SELECT c.id, c.parent, CASE WHEN into_cycle THEN NULL ELSE coalesce(depth, 0) END AS depth, CASE WHEN into_cycle THEN NULL ELSE coalesce(root, c.id) END AS root,
  CASE WHEN c.id IN (SELECT id FROM y) THEN 'cycle' WHEN into_cycle THEN 'into_cycle' WHEN lost THEN 'orphaned' ELSE 'ok' END AS state
FROM c LEFT JOIN x ON x.id = c.id""")
def category_tree(t):
    """The parent edge checked beyond a count of orphans: cycles, depths, roots, subtrees that hang in the air."""
    return hierarchy(t.part.select(F.col("p_partkey").alias("id"), F.expr(PARENT).alias("parent")), "id", "parent")
