"""Star schema, reports and health."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from siltstone import vocab
from siltstone.operators import quantiles, reports
from siltstone.operators.dedup import latest_per_key
from siltstone.operators.history import as_of, validity
from siltstone.operators.quality import Rule, any_rejects, not_positive, null_rule
from siltstone.operators.reconcile import reconcile_rows as reconcile_by_rows
from siltstone.operators.sketches import merged_quantiles, rank_error, update_sketches
from siltstone.operators.skew import skew_join
from siltstone.operators.typos import learn_typos
from siltstone.plans import gold
from siltstone.session import scratch_folder
from siltstone.sources.bronze import to_bronze
from siltstone.sources.files import spread_scan
from siltstone.sources.versions import VersionedTable
from workload.landing import TOPIC_SQL, as_messages
from workload.registry import ORACLES, TABLES, query

MONEY = "decimal(12,2)"


# --- silver-shaped frames out of the given tables -----------------------------------------------


def silver_customers(t):
    return t.customer.select(
        F.col("c_custkey").alias("id"), F.split_part("c_name", F.lit("#"), F.lit(1)).alias("first_name"),
        F.when(F.col("c_nationkey") > 0, F.split_part("c_name", F.lit("#"), F.lit(2))).alias("last_name"),
        F.concat(F.lit("c"), "c_custkey", F.lit("@example.com")).alias("email"), F.col("c_mktsegment").alias("gender"),
        F.expr("DATE '1980-01-01'").alias("date_of_birth"), F.expr("TIMESTAMP_NTZ '2020-01-01 00:00:00'").alias("created_at"))


CUSTOMERS_SQL = """SELECT c_custkey AS customer_key, concat_ws(' ', split_part(c_name, '#', 1), CASE WHEN c_nationkey > 0 THEN split_part(c_name, '#', 2) END) AS customer_name,
  concat('c', c_custkey, '@example.com') AS email, c_mktsegment AS gender, DATE '1980-01-01' AS date_of_birth, TIMESTAMP '2020-01-01' AS customer_since FROM customer"""


def silver_products(t):
    return t.part.select(
        F.col("p_partkey").alias("id"), F.concat(F.lit("SKU-"), "p_partkey").alias("sku"), F.col("p_name").alias("name"),
        F.col("p_brand").alias("brand"), F.col("p_size").alias("category_id"), F.col("p_retailprice").cast(MONEY).alias("price"),
        (F.col("p_retailprice") / 2).cast(MONEY).alias("cost"), (F.col("p_size") > 5).alias("is_active"))


PRODUCTS_SQL = """SELECT p_partkey AS product_key, concat('SKU-', p_partkey) AS sku, p_name AS product_name, p_brand AS brand, p_size AS category_id,
  CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS DOUBLE) AS list_price, p_size > 5 AS is_active FROM part"""

# A payment per order and a second attempt for some; every line is a shipment of its order.
PAYMENTS = """
SELECT o_orderkey * 10 AS id, o_orderkey AS order_id, CASE o_orderkey % 3 WHEN 0 THEN 'PAYPAL' WHEN 1 THEN 'CREDIT_CARD' ELSE 'APPLE_PAY' END AS payment_method,
  CAST(o_totalprice AS DECIMAL(12,2)) AS amount, CASE WHEN o_orderkey % 5 = 0 THEN 'FAILED' ELSE 'COMPLETED' END AS status,
  concat('TXN-', o_orderkey) AS transaction_id, o_orderdate + INTERVAL 1 DAY AS paid_at FROM orders WHERE o_orderstatus <> 'O'
UNION ALL SELECT o_orderkey * 10 + 1, o_orderkey, 'DEBIT_CARD', CAST(o_totalprice AS DECIMAL(12,2)), 'COMPLETED',
  concat('TXR-', o_orderkey), o_orderdate + INTERVAL 2 DAY FROM orders WHERE o_orderstatus <> 'O' AND o_orderkey % 5 = 0"""
SHIPMENTS = """
SELECT l_partkey * 10000 + l_suppkey AS id, l_orderkey AS order_id, CASE l_suppkey % 4 WHEN 0 THEN 'UPS' WHEN 1 THEN 'DHL' WHEN 2 THEN 'USPS' ELSE 'FedEx' END AS carrier,
  concat('TRK', l_orderkey, '-', l_linenumber) AS tracking_number, CASE l_linestatus WHEN 'F' THEN 'DELIVERED' ELSE 'IN_TRANSIT' END AS status,
  l_shipdate AS shipped_at, CASE l_linestatus WHEN 'F' THEN l_shipdate + INTERVAL 36 HOUR END AS delivered_at FROM lineitem"""


@query("dim_customers", CUSTOMERS_SQL)
def dim_customers(t):
    return gold.dim_customers(silver_customers(t))


@query("dim_products", PRODUCTS_SQL)
def dim_products(t):
    return gold.dim_products(silver_products(t)).drop("cost").withColumn("list_price", F.col("list_price").cast("double"))


@query("dim_payments", f"""
SELECT id AS payment_key, order_id, payment_method, CAST(amount AS DOUBLE) AS payment_amount, status AS payment_status, transaction_id, paid_at FROM ({PAYMENTS}) p""")
def dim_payments(t):
    return gold.dim_payments(t.sql(PAYMENTS)).withColumn("payment_amount", F.col("payment_amount").cast("double"))


@query("dim_shipping", f"""
SELECT id AS shipping_key, order_id, carrier, tracking_number, status AS shipping_status, shipped_at, delivered_at,
  (epoch(delivered_at) - epoch(shipped_at)) / 86400.0 AS delivery_days FROM ({SHIPMENTS}) s""")
def dim_shipping(t):
    return gold.dim_shipping(t.sql(SHIPMENTS))


@query("dim_date", """
WITH d AS (SELECT CAST(unnest(generate_series(CAST(min(o_orderdate) AS DATE), CAST(max(o_orderdate) AS DATE), INTERVAL 1 DAY)) AS DATE) AS date FROM orders)
SELECT CAST(year(date) * 10000 + month(date) * 100 + day(date) AS INTEGER) AS date_key, date, CAST(year(date) AS INTEGER) AS year,
  CAST(quarter(date) AS INTEGER) AS quarter, CAST(month(date) AS INTEGER) AS month, CAST(day(date) AS INTEGER) AS day,
  CAST(isodow(date) AS INTEGER) AS iso_weekday, CAST(weekofyear(date) AS INTEGER) AS iso_week, isodow(date) >= 6 AS is_weekend FROM d""")
def dim_date(t):
    return gold.dim_date(t.orders, "o_orderdate")


def silver_orders(t):
    money = F.col("o_totalprice").cast(MONEY)
    zero = F.lit(0).cast(MONEY)
    return t.orders.select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("customer_id"), F.col("o_orderstatus").alias("status"),
        F.col("o_orderdate").alias("order_date"), money.alias("subtotal"), zero.alias("discount_amount"),
        zero.alias("tax_amount"), zero.alias("shipping_cost"), money.alias("total_amount"))


def silver_items(t):
    return spread_scan(t.lineitem, t.spark.sparkContext.defaultParallelism).select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"), F.col("l_quantity").cast("int").alias("quantity"),
        F.floor(F.col("l_extendedprice") / F.col("l_quantity")).cast(MONEY).alias("unit_price"),
        F.col("l_extendedprice").cast(MONEY).alias("total_price"))


FACT_SQL = f"""
pm AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY paid_at DESC, id DESC) AS rn FROM ({PAYMENTS}) p) x WHERE rn = 1),
sh AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY shipped_at DESC, id DESC) AS rn FROM ({SHIPMENTS}) s) x WHERE rn = 1),
c AS ({CUSTOMERS_SQL}), p AS ({PRODUCTS_SQL}),
fact AS (SELECT l_orderkey * 10 + l_linenumber AS order_item_key, o_orderkey AS order_key, c.customer_key, p.product_key, pm.id AS payment_key, sh.id AS shipping_key,
  o_orderstatus AS order_status, o_orderdate AS order_date, CAST(year(o_orderdate) AS INTEGER) AS order_year, CAST(month(o_orderdate) AS INTEGER) AS order_month,
  CAST(day(o_orderdate) AS INTEGER) AS order_day, CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DOUBLE) AS subtotal, CAST(0 AS DOUBLE) AS discount_amount,
  CAST(0 AS DOUBLE) AS tax_amount, CAST(0 AS DOUBLE) AS shipping_cost, CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DOUBLE) AS order_total,
  CAST(l_quantity AS INTEGER) AS quantity, CAST(CAST(floor(l_extendedprice / l_quantity) AS DECIMAL(12,2)) AS DOUBLE) AS unit_price, CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS DOUBLE) AS item_total,
  c.customer_name, c.gender, p.sku, p.product_name, p.brand, p.list_price, pm.payment_method, pm.status AS payment_status, sh.carrier, sh.status AS shipping_status,
  (epoch(sh.delivered_at) - epoch(sh.shipped_at)) / 86400.0 AS delivery_days
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey LEFT JOIN c ON o_custkey = c.customer_key LEFT JOIN p ON l_partkey = p.product_key
  LEFT JOIN pm ON pm.order_id = o_orderkey LEFT JOIN sh ON sh.order_id = o_orderkey)"""


def build_fact(t):
    return gold.fact_sales(
        silver_items(t), silver_orders(t), gold.dim_customers(silver_customers(t)), gold.dim_products(silver_products(t)),
        gold.dim_payments(t.sql(PAYMENTS)), gold.dim_shipping(t.sql(SHIPMENTS)))


@query("fact_sales", f"WITH {FACT_SQL.strip()} SELECT * FROM fact")
def fact_sales(t):
    fact = build_fact(t)
    money = ["subtotal", "discount_amount", "tax_amount", "shipping_cost", "order_total", "unit_price", "item_total", "list_price"]
    return fact.withColumns({c: F.col(c).cast("double") for c in money})


@query("fact_fanout", f"""
SELECT payment_key, count(*) AS rows FROM (SELECT p.id AS payment_key, s.id AS shipping_key FROM lineitem
  LEFT JOIN ({PAYMENTS}) p ON p.order_id = l_orderkey LEFT JOIN ({SHIPMENTS}) s ON s.order_id = l_orderkey
  WHERE EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey)) f GROUP BY ALL""")
def fact_fanout(t):
    """Item rows repeated per payment and shipment, as a plain star join would give them."""
    return gold.fanout_rows(silver_items(t), silver_orders(t), gold.dim_payments(t.sql(PAYMENTS)), gold.dim_shipping(t.sql(SHIPMENTS)))


@query("top_brands", """
SELECT p_brand AS brand, count(*) AS items_sold, CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS DOUBLE) AS revenue
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1 ORDER BY revenue DESC, brand LIMIT 5""")
def top_brands(t):
    goods = t.part.select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("brand"))
    sold = skew_join(t.lineitem, goods, ["l_partkey"], "inner").select("brand", F.col("l_extendedprice").cast(MONEY).alias("item_total"))
    return reports.top_brands(sold, 5)


# --- counts and checks --------------------------------------------------------------------------


@query("layer_counts", " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS row_count FROM {n}" for n in TABLES))
def layer_counts(t):
    return reports.layer_counts({n: getattr(t, n) for n in TABLES})


RECONCILE_SQL = """
SELECT 'fact vs items' AS "check", f.n AS left_rows, i.n AS right_rows, f.n / i.n AS ratio, CASE WHEN f.n = i.n THEN 'OK' ELSE 'WARN' END AS status
FROM (SELECT count(*) AS n FROM lineitem WHERE EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey)) f, (SELECT count(*) AS n FROM lineitem) i
UNION ALL SELECT 'log vs source', a.n, b.n, a.n / b.n, CASE WHEN a.n >= b.n THEN 'OK' ELSE 'WARN' END
FROM (SELECT count(*) AS n FROM cdc_orders) a, (SELECT count(*) AS n FROM orders) b
UNION ALL SELECT 'silver vs source', a.n, b.n, a.n / b.n, CASE WHEN a.n <= b.n THEN 'OK' ELSE 'WARN' END
FROM (SELECT count(*) AS n FROM dirty_orders WHERE total_amount IS NOT NULL) a, (SELECT count(*) AS n FROM orders) b"""


def reconciliation(t):
    heads = t.orders.select(F.col("o_orderkey").alias("l_orderkey"))
    return reports.reconcile([
        ("fact vs items", skew_join(t.lineitem, heads, ["l_orderkey"], "left_semi"), t.lineitem, "equal"),
        ("log vs source", t.cdc_orders, t.orders, "at_least"),
        ("silver vs source", t.dirty_orders.dropna(subset=["total_amount"]), t.orders, "at_most"),
    ])


@query("reconcile", RECONCILE_SQL, uses=("cdc_orders", "dirty_orders"))
def reconcile(t):
    return reconciliation(t)


FRESH_NOW = "2024-01-31 00:00:00"
FRESH_SQL = f"""
SELECT newest, age_seconds, CASE WHEN age_seconds < 60 THEN 'OK' WHEN age_seconds < 600 THEN 'WARN' ELSE 'FAIL' END AS status
FROM (SELECT max(ts) AS newest, CAST(epoch(TIMESTAMP '{FRESH_NOW}') - floor(epoch(max(ts))) AS BIGINT) AS age_seconds FROM events) f"""


@query("freshness", FRESH_SQL)
def freshness(t):
    return reports.freshness(t.events, "ts", F.expr(f"TIMESTAMP_NTZ '{FRESH_NOW}'"))


EXPECTED_ROWS = ", ".join(f"('{x}')" for x in vocab.EXPECTED_TOPICS)
TOPIC_STATS_SQL = f"""
WITH s AS (SELECT topic, event_id % 4 AS part, count(*) AS n, max(event_id // 4) + 1 AS off FROM (SELECT {TOPIC_SQL} AS topic, event_id FROM events) e GROUP BY ALL),
a AS (SELECT topic, n, off, 1 AS p FROM s UNION ALL SELECT topic, 0, 0, 0 FROM (VALUES {EXPECTED_ROWS}) v(topic)),
g AS (SELECT topic, CAST(sum(n) AS BIGINT) AS messages, CAST(sum(off) AS BIGINT) AS end_offsets, CAST(sum(p) AS BIGINT) AS partitions FROM a GROUP BY 1)
SELECT *, CASE WHEN messages = 0 AND NOT ends_with(topic, '.dlq') THEN 'WARN' ELSE 'OK' END AS status FROM g"""


@query("topic_stats", TOPIC_STATS_SQL)
def topic_stats(t):
    return reports.topic_stats(to_bronze(as_messages(t.events)))


@query("health_verdict", f"""
WITH r AS ({RECONCILE_SQL}), f AS ({FRESH_SQL}), k AS ({TOPIC_STATS_SQL}), u AS (SELECT status FROM r UNION ALL SELECT status FROM f UNION ALL SELECT status FROM k),
c AS (SELECT count(*) FILTER (WHERE status = 'OK') AS ok, count(*) FILTER (WHERE status = 'WARN') AS warnings, count(*) FILTER (WHERE status = 'FAIL') AS failures FROM u)
SELECT *, CASE WHEN failures > 0 THEN 'FAIL' WHEN warnings > 0 THEN 'WARN' ELSE 'OK' END AS verdict FROM c""", uses=("cdc_orders", "dirty_orders"))
def health_verdict(t):
    checks = reconciliation(t).select("status").unionByName(freshness(t).select("status")).unionByName(topic_stats(t).select("status"))
    return reports.health_verdict(checks)


@query("quality_counts", """
WITH o AS (SELECT 'orders' AS entity, CASE WHEN total_amount IS NULL OR coalesce(_quality_flag, 'CLEAN') <> 'CLEAN' THEN 'dead_letter' ELSE 'silver' END AS route FROM dirty_orders
  UNION ALL SELECT 'customers', CASE WHEN email IS NULL OR balance <= 0 THEN 'dead_letter' ELSE 'silver' END FROM dirty_customers),
n AS (SELECT entity, route, count(*) AS row_count FROM o GROUP BY ALL)
SELECT entity, route, row_count, row_count / sum(row_count) OVER (PARTITION BY entity) AS share FROM n""", uses=("dirty_orders", "dirty_customers"))
def quality_counts(t):
    return reports.quality_counts(_routed_tables(t))


def _routed_tables(t):
    def routed(df, rules: list[Rule], flag=None):
        bad = any_rejects(rules)
        if flag:
            bad = bad | (F.coalesce(F.col(flag), F.lit(vocab.CLEAN)) != vocab.CLEAN)
        return df.withColumn("_route", F.when(bad, "dead_letter").otherwise("silver"))

    return {
        "orders": routed(t.dirty_orders, [null_rule("total_amount")], "_quality_flag"),
        "customers": routed(t.dirty_customers, [null_rule("email"), not_positive("balance")]),
    }


@query("observed_quality", ORACLES["quality_counts"])
def observed_quality(t):
    """The same counts, as the writes of the routed tables have seen them."""
    return reports.observed_quality_counts(_routed_tables(t), scratch_folder(t.spark, "observed"))


@query("iqr_outliers", """
WITH q AS (SELECT quantile_cont(l_extendedprice, 0.25) AS q1, quantile_cont(l_extendedprice, 0.75) AS q3 FROM lineitem),
b AS (SELECT q1, q3, q3 - q1 AS iqr, q1 - 0.2 * (q3 - q1) AS low, q3 + 0.2 * (q3 - q1) AS high FROM q)
SELECT coalesce(l_extendedprice < low OR l_extendedprice > high, false) AS is_outlier, count(*) AS rows, min(l_extendedprice) AS smallest, max(l_extendedprice) AS largest
FROM lineitem, b GROUP BY 1""")
def iqr_outliers(t):
    rows = quantiles.flag_outliers(t.lineitem.select("l_extendedprice"), "l_extendedprice", 0.2)
    return rows.groupBy("is_outlier").agg(
        F.count(F.lit(1)).alias("rows"), F.min("l_extendedprice").alias("smallest"), F.max("l_extendedprice").alias("largest"))


@query("iqr_bounds", """
SELECT q1, q3, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS low, q3 + 1.5 * (q3 - q1) AS high
FROM (SELECT quantile_cont(o_totalprice, 0.25) AS q1, quantile_cont(o_totalprice, 0.75) AS q3 FROM orders) q""")
def iqr_bounds(t):
    return quantiles.iqr_bounds(t.orders, "o_totalprice")


@query("drop_outliers", """
WITH q AS (SELECT quantile_cont(c_acctbal, 0.25) AS q1, quantile_cont(c_acctbal, 0.75) AS q3 FROM customer)
SELECT c_custkey, c_acctbal FROM customer, q WHERE c_acctbal BETWEEN q1 - 0.3 * (q3 - q1) AND q3 + 0.3 * (q3 - q1)""")
def drop_outliers(t):
    return quantiles.drop_outliers(t.customer.select("c_custkey", "c_acctbal"), "c_acctbal", 0.3)


COUPONS_SQL = "SELECT o_orderpriority AS code, max(CAST(o_orderdate AS DATE)) AS valid_until, true AS is_active, 10000 AS max_uses FROM orders GROUP BY 1"


@query("coupon_usage", f"""
WITH c AS ({COUPONS_SQL}), u AS (SELECT o_orderpriority AS code, count(*) AS n FROM orders WHERE o_orderstatus = 'F' GROUP BY 1)
SELECT c.code, c.max_uses, coalesce(n, 0) AS times_used_actual, c.max_uses - coalesce(n, 0) AS remaining FROM c LEFT JOIN u ON u.code = c.code""")
def coupon_usage(t):
    coupons = t.sql(COUPONS_SQL).select("code", "max_uses")
    used = t.orders.filter(F.col("o_orderstatus") == "F")
    return reports.coupon_usage(coupons, used, "o_orderpriority", "code")


@query("expire_flags", """
SELECT o_orderkey, o_orderdate AS valid_until, o_orderstatus <> 'P' AND NOT coalesce(o_orderdate < TIMESTAMP '1998-06-01', false) AS is_active FROM orders""")
def expire_flags(t):
    coupons = t.orders.select("o_orderkey", F.col("o_orderdate").alias("valid_until"), (F.col("o_orderstatus") != "P").alias("is_active"))
    return reports.expire_coupons(coupons, F.expr("TIMESTAMP_NTZ '1998-06-01 00:00:00'"))


@query("latest_shipment", f"""
SELECT order_id, id, shipped_at FROM (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY shipped_at DESC, id DESC) AS rn FROM ({SHIPMENTS}) s) x WHERE rn = 1""")
def latest_shipment(t):
    return latest_per_key(t.sql(SHIPMENTS), ["order_id"], "shipped_at", ["id"]).select("order_id", "id", "shipped_at")


@query("reconcile_rows", """
WITH c AS (SELECT CASE WHEN o_orderkey % 101 = 5 THEN o_orderkey + 1000000000000 ELSE o_orderkey END AS o_orderkey, o_custkey,
  CASE WHEN o_orderkey % 83 = 1 THEN NULL ELSE o_orderstatus END AS o_orderstatus, CASE WHEN o_orderkey % 89 = 7 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice FROM orders WHERE o_orderkey % 97 <> 3
  UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderkey % 211 = 9),
l AS (SELECT o_orderkey, count(*) AS n, min(o_custkey) AS c, min(o_orderstatus) AS s, min(o_totalprice) AS p FROM orders GROUP BY 1),
r AS (SELECT o_orderkey, count(*) AS n, min(o_custkey) AS c, min(o_orderstatus) AS s, min(o_totalprice) AS p FROM c GROUP BY 1)
SELECT o_orderkey, CASE WHEN r.n IS NULL THEN 'missing' WHEN l.n IS NULL THEN 'extra' ELSE 'changed' END AS state, coalesce(l.n, 0) AS source_rows, coalesce(r.n, 0) AS copy_rows,
  CASE WHEN l.n = 1 AND r.n = 1 THEN concat_ws(',', CASE WHEN l.c IS DISTINCT FROM r.c THEN 'o_custkey' END, CASE WHEN l.s IS DISTINCT FROM r.s THEN 'o_orderstatus' END,
    CASE WHEN l.p IS DISTINCT FROM r.p THEN 'o_totalprice' END) END AS columns
FROM l FULL JOIN r USING (o_orderkey) WHERE l.n IS DISTINCT FROM r.n OR l.c IS DISTINCT FROM r.c OR l.s IS DISTINCT FROM r.s OR l.p IS DISTINCT FROM r.p""")
def reconciled_rows(t):
    """A copy of the orders with some lost, some moved to other keys, some twice, and some with other values, against the orders."""
    key, source = F.col("o_orderkey"), t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    copy = source.filter(key % 97 != 3).select(
        F.when(key % 101 == 5, key + 1000000000000).otherwise(key).alias("o_orderkey"), "o_custkey", F.when(key % 83 != 1, F.col("o_orderstatus")).alias("o_orderstatus"),
        F.when(key % 89 == 7, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")).alias("o_totalprice"))
    out = reconcile_by_rows(source, copy.unionByName(source.filter(key % 211 == 9)), ["o_orderkey"])
    return out.withColumn("columns", F.array_join("columns", ","))


@query("iqr_bounds_merged", """
SELECT p AS probability, (SELECT count(value) FROM events) AS n, true AS within FROM (VALUES (0.25::DOUBLE), (0.5::DOUBLE), (0.75::DOUBLE)) v(p)""")
def iqr_bounds_merged(t):
    """Quantiles over all days from sketches kept by day and brought up to date twice, held against the ranks in the whole table: within
    the stated error or not."""
    table = VersionedTable(t.spark, f"{scratch_folder(t.spark, 'sketches')}/value")
    rows = t.events.select("value", F.col("ts").cast("date").alias("day"))
    update_sketches(table, rows.filter("day < DATE '2024-01-20'"), "value", "day")
    update_sketches(table, rows, "value", "day", since=datetime.date(2024, 1, 15))
    wanted = (0.25, 0.5, 0.75)
    found = merged_quantiles(table.read(), wanted)
    values, n, error = found.select("quantiles").scalar(), found.select("n").scalar(), rank_error()
    ranks = rows.withColumn("q", values).agg(*[
        F.struct(F.lit(p).alias("probability"), (F.count_if(F.col("value") < F.col("q")[k]) / F.count("value")).alias("below"),
                 (F.count_if(F.col("value") <= F.col("q")[k]) / F.count("value")).alias("upto")).alias(f"p{k}") for k, p in enumerate(wanted)])
    return ranks.select(F.inline(F.array(*[f"p{k}" for k in range(len(wanted))]))).select(
        "probability", n.alias("n"), ((F.col("below") - error <= F.col("probability")) & (F.col("probability") <= F.col("upto") + error)).alias("within"))


@query("fact_as_of", """
WITH v AS (SELECT o_custkey, o_orderdate AS valid_from, o_orderpriority AS tier, o_orderkey, lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS valid_to
  FROM orders WHERE o_orderkey % 3 = 0),
u AS (SELECT * FROM v WHERE tier <> '5-LOW' AND (valid_to IS NULL OR valid_to > valid_from))
SELECT f.o_orderkey, f.o_custkey, u.tier FROM orders f LEFT JOIN u ON u.o_custkey = f.o_custkey AND u.valid_from <= f.o_orderdate AND (u.valid_to IS NULL OR u.valid_to > f.o_orderdate)
WHERE f.o_orderkey % 3 = 1""")
def fact_as_of(t):
    """Orders with the tier that their customer was in at the time, from a log of changes in which one tier stands for a deletion."""
    log = t.orders.filter("o_orderkey % 3 = 0").select("o_custkey", "o_orderdate", F.col("o_orderpriority").alias("tier"), "o_orderkey")
    states = validity(log, "o_custkey", "o_orderdate", ["o_orderkey"], deleted="tier = '5-LOW'").select("o_custkey", "tier", "valid_from", "valid_to")
    facts = t.orders.filter("o_orderkey % 3 = 1").select("o_orderkey", "o_custkey", "o_orderdate")
    return as_of(facts, states, "o_custkey", "o_orderdate").select("o_orderkey", "o_custkey", "tier")


@query("dim_customers_history", """
WITH l AS (SELECT id, __op, __source_ts_ms, status, lead(__source_ts_ms) OVER (PARTITION BY id ORDER BY __source_ts_ms) AS valid_to FROM cdc_orders)
SELECT id, status, __source_ts_ms AS valid_from, valid_to, valid_to IS NULL AS is_current FROM l WHERE __op <> 'd'""", uses=("cdc_orders",))
def dim_history(t):
    """The states that each row of a change log was in; a deletion ends the last."""
    return validity(t.cdc_orders, "id", "__source_ts_ms", deleted="__op = 'd'").select("id", "status", "valid_from", "valid_to", "is_current")


# A tenth of the names misspelt, each in its own way.
SPELT = """CASE WHEN p_partkey % 40 = 7 THEN concat(substr(w, 1, 3), substr(w, 5)) WHEN p_partkey % 40 = 9 THEN concat(substr(w, 1, 4), 'x', substr(w, 5))
  WHEN p_partkey % 40 = 11 THEN concat(substr(w, 1, 2), 'q', substr(w, 4)) WHEN p_partkey % 40 = 13 THEN concat(' ', upper(substr(w, 2)), 'z') ELSE w END"""


@query("typo_map_learned", f"""
WITH n AS (SELECT lower(trim(v)) AS value, count(*) AS rows FROM (SELECT {SPELT} AS v FROM (SELECT p_partkey, concat(p_brand, ' ', p_type) AS w FROM part) q) p WHERE trim(v) <> '' GROUP BY 1),
c AS (SELECT a.value, a.rows, b.value AS fixed, b.rows AS fixed_rows, levenshtein(a.value, b.value) AS distance FROM n a JOIN n b ON b.rows >= 4 * a.rows AND a.value <> b.value)
SELECT value, rows, fixed, fixed_rows, CAST(distance AS INTEGER) AS distance FROM c WHERE distance <= 2
QUALIFY row_number() OVER (PARTITION BY value ORDER BY distance, fixed_rows DESC, fixed) = 1""")
def typo_map_learned(t):
    """Misspelt names and what they are taken for, learned from how often each spelling occurs."""
    words = t.part.select("p_partkey", F.concat("p_brand", F.lit(" "), "p_type").alias("w"))
    return learn_typos(words.select(F.expr(SPELT).alias("v")), "v", ratio=4)
