"""Rules, routing, dead letters, state from events."""

from __future__ import annotations

from pyspark.sql import functions as F

from siltstone import vocab
from siltstone.functions import numbers, text, times
from siltstone.operators import quality as q
from siltstone.operators import status as st
from siltstone.operators.missing import placeholders_to_null
from siltstone.plans.cleaning import CleaningConfig, clean_table
from workload.cleaning import BLANKED, CLEAN_NUMBER, DATES, TYPO_CASE
from workload.registry import query

NOW = "TIMESTAMP '2024-02-01 00:00:00'"
NOW_NTZ = "TIMESTAMP_NTZ '2024-02-01 00:00:00'"


@query("split_required", """
SELECT coalesce(_quality_flag, 'CLEAN') IN ('DIRTY', 'QUARANTINE') OR total_amount IS NULL OR status IS NULL AS dirty,
  coalesce(_quality_flag, '-') AS flag, count(*) AS rows, CAST(sum(id) AS BIGINT) AS id_sum FROM dirty_orders GROUP BY ALL""", uses=("dirty_orders",))
def split_required(t):
    clean, dirty = q.split_required(t.dirty_orders, ["id", "total_amount", "status"])
    both = clean.withColumn("dirty", F.lit(False)).unionByName(dirty.withColumn("dirty", F.lit(True)))
    return both.groupBy("dirty", F.coalesce("_quality_flag", F.lit("-")).alias("flag")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum("id").alias("id_sum"))


@query("tag_rules", f"""
WITH e AS (SELECT lower(trim(email)) AS m, count(*) AS n FROM dirty_customers WHERE email IS NOT NULL GROUP BY 1),
f AS (SELECT c.*, coalesce(e.n > 1, false) AS dup, email IS NULL AS r1,
    email IS NOT NULL AND NOT regexp_full_match(lower(trim(email)), '[^@\\s]+@[^@\\s]+\\.[^@\\s]+') AS r2,
    length(phone) > 20 AS r3, balance < 0 AS r5 FROM dirty_customers c LEFT JOIN e ON lower(trim(c.email)) = e.m)
SELECT id, array_to_string(list_filter([CASE WHEN r1 THEN 'null_email' END, CASE WHEN r2 THEN 'invalid_email' END,
  CASE WHEN r3 THEN 'phone_too_long' END, CASE WHEN dup THEN 'duplicate_email' END, CASE WHEN r5 THEN 'negative_balance' END], lambda x: x IS NOT NULL), ',') AS reasons,
  CAST((CASE WHEN r1 THEN 3 ELSE 0 END) + (CASE WHEN r2 THEN 2 ELSE 0 END) + (CASE WHEN r3 THEN 1 ELSE 0 END) + (CASE WHEN dup THEN 2 ELSE 0 END)
   + (CASE WHEN r5 THEN 3 ELSE 0 END) AS INTEGER) AS score FROM f""", uses=("dirty_customers",))
def tag_rules(t):
    """The customer rules; a shared address is found across rows, whoever holds it."""
    rows = t.dirty_customers.withColumn("email", text.lower_trim(F.col("email")))
    rows = q.with_repeat_flag(rows, ["email"], "duplicate_email")
    rules = [q.null_rule("email"), q.invalid_email(), q.phone_too_long(), q.flagged("duplicate_email"), q.negative("balance")]
    return q.tag_rules(rows, rules).select(
        "id", F.array_join("_reasons", ",").alias("reasons"), F.col("_dirty_score").alias("score"))


@query("tag_order_rules", f"""
WITH o AS (SELECT d.id, d.status, {CLEAN_NUMBER} AS amount, {DATES} AS dated, p.c_custkey IS NULL AS orphan, l.k IS NULL AS hollow
  FROM dirty_orders d LEFT JOIN customer p ON d.customer_id = p.c_custkey
  LEFT JOIN (SELECT DISTINCT l_orderkey AS k FROM lineitem) l ON l.k = d.id)
SELECT id, array_to_string(list_filter([CASE WHEN upper(trim(status)) NOT IN ({', '.join(f"'{s}'" for s in vocab.ORDER_STATUSES)}) THEN 'status_typo' END,
  CASE WHEN dated > TIMESTAMP '2001-01-01' THEN 'future_order_date' END, CASE WHEN amount < 0 THEN 'negative_amount' END,
  CASE WHEN orphan THEN 'mismatched_customer_ref' END, CASE WHEN hollow THEN 'missing_items' END,
  CASE WHEN year(dated) > 2002 THEN 'implausible_year' END], lambda x: x IS NOT NULL), ',') AS reasons FROM o""", uses=("dirty_orders",))
def tag_order_rules(t):
    as_of = F.expr("TIMESTAMP '2001-01-01'")
    rows = t.dirty_orders.withColumns({
        "amount": numbers.clean_number(F.col("total_amount")),
        "order_date": times.parse_date_formats(F.col("order_date")),
    })
    rows = q.with_orphan_flag(rows, "customer_id", t.customer, "c_custkey", "mismatched_customer_ref")
    rows = q.with_orphan_flag(rows, "id", t.lineitem, "l_orderkey", "missing_items")
    rules = [
        q.status_typo(), q.future_order_date(as_of), q.negative("amount"), q.flagged("mismatched_customer_ref"),
        q.flagged("missing_items"), q.implausible_year("order_date", as_of),
    ]
    return q.tag_rules(rows, rules).select("id", F.array_join("_reasons", ",").alias("reasons"))


PART_TAGS = r"""
SELECT *, body <> '' AND sku <> '' AND 'SKU-' || body <> upper(sku) AS variant, price IS NULL AS no_price,
  price = 0 AS zero, stock_quantity < 0 AS low FROM (SELECT *, regexp_replace(regexp_replace(regexp_replace(upper(trim(sku)), '^SKU[-_]?', ''),
  '-[A-Z]{2,3}$', ''), '[^A-Z0-9]', '', 'g') AS body FROM dirty_parts) b"""
PART_FLAG = "CASE WHEN zero THEN 'QUARANTINE' WHEN no_price OR variant OR low THEN 'DIRTY' ELSE 'CLEAN' END"


def _tagged_parts(t):
    """Part rules; a price of zero may be a sale, so it goes to quarantine."""
    rules = [q.sku_format_variant(), q.null_rule("price"), q.zero_price(), q.negative("stock_quantity", "negative_stock")]
    tagged = q.tag_rules(t.dirty_parts, rules)
    flag = (
        F.when(F.array_contains("_reasons", "zero_price"), vocab.QUARANTINE)
        .when(F.size("_reasons") > 0, vocab.DIRTY).otherwise(vocab.CLEAN)
    )
    return tagged.withColumn("_quality_flag", flag)


@query("auto_fix", f"""
SELECT id, CASE WHEN f = 'DIRTY' AND variant AND NOT no_price AND NOT low THEN 'SKU-' || body ELSE sku END AS sku,
  CASE WHEN f = 'DIRTY' AND variant AND NOT no_price AND NOT low THEN 'CLEAN' ELSE f END AS flag,
  CASE WHEN f = 'DIRTY' AND variant AND NOT no_price AND NOT low THEN 'sku normalised' END AS note
FROM (SELECT *, {PART_FLAG} AS f FROM ({PART_TAGS}) p) x""", uses=("dirty_parts",))
def auto_fix(t):
    fixed = q.auto_fix(_tagged_parts(t))
    return fixed.select("id", "sku", F.col("_quality_flag").alias("flag"), F.col("_auto_fix_note").alias("note"))


@query("route_quality", """
WITH f AS (SELECT *, CASE event_type WHEN 'error' THEN 'QUARANTINE' WHEN 'click' THEN 'DIRTY' WHEN 'signup' THEN NULL ELSE 'CLEAN' END AS flag FROM events)
SELECT event_id, CASE coalesce(flag, 'CLEAN') WHEN 'CLEAN' THEN 'silver' WHEN 'DIRTY' THEN 'dead_letter' ELSE 'quarantine' END AS route,
  CAST(CASE WHEN flag = 'DIRTY' THEN user_id % 3 + 1 ELSE user_id % 3 END AS INTEGER) AS retries,
  CASE WHEN flag = 'DIRTY' THEN TIMESTAMP '2024-02-01 00:00:00' END AS dead_at FROM f""")
def route_quality(t):
    rows = t.events.withColumns({
        "_quality_flag": F.when(F.col("event_type") == "error", vocab.QUARANTINE).when(F.col("event_type") == "click", vocab.DIRTY)
        .when(F.col("event_type") != "signup", vocab.CLEAN),
        "_retry_count": (F.col("user_id") % 3).cast("int"),
    })
    out = q.route_quality(rows, F.expr(NOW_NTZ))
    return out.select("event_id", F.col("_route").alias("route"), F.col("_retry_count").alias("retries"),
                      F.col("_dlq_ingested_at").alias("dead_at"))


@query("dlq_union", f"""
WITH c AS (SELECT id, 'customers' AS src, email IS NULL AS bad, 'DIRTY' AS flag FROM dirty_customers),
o AS (SELECT id, 'orders' AS src, coalesce(_quality_flag, 'CLEAN') IN ('DIRTY', 'QUARANTINE') OR total_amount IS NULL AS bad, coalesce(_quality_flag, 'DIRTY') AS flag FROM dirty_orders),
p AS (SELECT id, 'parts' AS src, price IS NULL OR sku IS NULL AS bad, 'DIRTY' AS flag FROM dirty_parts)
SELECT CAST(id AS VARCHAR) AS id, flag AS _quality_flag, src AS _source, {NOW} AS _bronze_ingested_at
FROM (SELECT * FROM c UNION ALL SELECT * FROM o UNION ALL SELECT * FROM p) u WHERE bad""",
       uses=("dirty_orders", "dirty_customers", "dirty_parts"))
def dlq_union(t):
    rejects = {
        "customers": q.split_required(t.dirty_customers, ["id", "email"])[1],
        "orders": q.split_required(t.dirty_orders, ["id", "total_amount"])[1],
        "parts": q.split_required(t.dirty_parts, ["id", "sku", "price"])[1],
    }
    return q.dead_letters(rejects, F.expr(NOW_NTZ)).select("id", "_quality_flag", "_source", "_bronze_ingested_at")


@query("dlq_replay", f"""
WITH d AS (SELECT *, CAST(id % 4 AS INTEGER) AS tries FROM ({PART_TAGS}) p WHERE variant OR no_price OR low OR zero),
r AS (SELECT * FROM d WHERE tries < 3 AND NOT EXISTS (SELECT 1 FROM part WHERE p_partkey = d.id AND p_size = 1)),
x AS (SELECT *, variant AND NOT no_price AND NOT low AND NOT zero AS fixed FROM r)
SELECT id, CASE WHEN fixed THEN 'SKU-' || body ELSE sku END AS sku, CASE WHEN fixed THEN 'silver' ELSE 'dead_letter' END AS route,
  CAST(CASE WHEN fixed THEN tries ELSE tries + 1 END AS INTEGER) AS retries FROM x""", uses=("dirty_parts",))
def dlq_replay(t):
    """Dead parts tried again, except those out of retries or accepted meanwhile."""
    rules = [q.sku_format_variant(), q.null_rule("price"), q.zero_price(), q.negative("stock_quantity", "negative_stock")]
    dead = q.tag_rules(t.dirty_parts, rules).filter(F.size("_reasons") > 0).withColumns({
        "_quality_flag": F.lit(vocab.DIRTY), "_retry_count": (F.col("id") % 4).cast("int")})
    accepted = t.part.filter(F.col("p_size") == 1).select(F.col("p_partkey").alias("id"))
    out = q.replay_dead_letters(dead, rules, ["id", "price"], accepted, ["id"], F.expr(NOW_NTZ))
    return out.select("id", "sku", F.col("_route").alias("route"), F.col("_retry_count").alias("retries"))


# --- state --------------------------------------------------------------------------------------

# Some steps carry no status, some no key.
STEP_OF = "CASE WHEN event_id % 13 = 0 THEN NULL WHEN event_type = 'signup' THEN 'pending' WHEN event_type = 'view' THEN 'picked_up' WHEN event_type = 'click' THEN 'in_transit' WHEN event_type = 'purchase' THEN 'delivered' ELSE 'returned' END"
STEP_KEY = "CASE WHEN event_id % 17 <> 0 THEN user_id END"


def _steps(t):
    return t.events.select("event_id", "ts", F.expr(STEP_KEY).alias("user_id"), F.expr(STEP_OF).alias("status_to"))


@query("status_fold", f"""
WITH s AS (SELECT event_id, ts, {STEP_KEY} AS user_id, {STEP_OF} AS status_to FROM events),
f AS (SELECT user_id, arg_max(status_to, (ts, event_id)) FILTER (WHERE status_to IS NOT NULL) AS status, min(ts) FILTER (WHERE status_to = 'picked_up') AS shipped_at,
  min(ts) FILTER (WHERE status_to = 'delivered') AS delivered_at FROM s GROUP BY 1)
SELECT c_custkey AS user_id, coalesce(f.status, 'none') AS status, shipped_at, delivered_at FROM customer LEFT JOIN f ON c_custkey = user_id""")
def status_fold(t):
    entity = t.customer.select(F.col("c_custkey").alias("user_id"), F.lit("none").alias("status"))
    return st.apply_status_events(entity, _steps(t), "user_id", "ts", "event_id").select(
        "user_id", "status", "shipped_at", "delivered_at")


@query("illegal_transitions", f"""
WITH s AS (SELECT event_id, ts, {STEP_KEY} AS user_id, {STEP_OF} AS status_to FROM events),
l AS (SELECT *, lag(status_to) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM s)
SELECT event_id, user_id, prev AS status_from, status_to FROM l WHERE prev IS NOT NULL AND prev <> status_to
  AND NOT ((prev = 'pending' AND status_to = 'picked_up') OR (prev = 'picked_up' AND status_to = 'in_transit')
  OR (prev = 'in_transit' AND status_to = 'out_for_delivery') OR (prev = 'out_for_delivery' AND status_to = 'delivered'))""")
def illegal_transitions(t):
    bad = st.illegal_transitions(_steps(t), ["user_id"], "status_to", "ts", "event_id", vocab.SHIPPING_FLOW, chunk="DAY")
    return bad.select("event_id", "user_id", F.col("_previous").alias("status_from"), "status_to")


@query("illegal_pairs", """
SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag AS status_from, l_linestatus AS status_to FROM lineitem
WHERE NOT ((l_returnflag = 'N' AND l_linestatus = 'O') OR (l_returnflag = 'A' AND l_linestatus = 'F'))""")
def illegal_pairs(t):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey",
                             F.col("l_returnflag").alias("status_from"), F.col("l_linestatus").alias("status_to"))
    return st.illegal_pairs(rows, (("N", "O"), ("A", "F")))


@query("delivery_notices", """
SELECT o_orderkey AS order_id, CASE WHEN l.k IS NOT NULL THEN 'delivered' ELSE o_orderstatus END AS status
FROM orders LEFT JOIN (SELECT DISTINCT l_orderkey AS k FROM lineitem WHERE l_linestatus = 'F') l ON k = o_orderkey""")
def delivery_notices(t):
    heads = t.orders.select(F.col("o_orderkey").alias("order_id"), F.col("o_orderstatus").alias("status"))
    notices = t.lineitem.filter(F.col("l_linestatus") == "F").select(F.col("l_orderkey").alias("order_id"))
    return st.apply_delivery_notices(heads, notices)


@query("stock_updates", """
WITH u AS (SELECT user_id AS p, CAST(json_extract_string(props, '$.k') AS INTEGER) AS stock, CAST(value AS DECIMAL(12,2)) AS price,
  row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
SELECT p_partkey AS product_id, coalesce(u.stock, p_size) AS stock_quantity,
  CAST(coalesce(u.price, CAST(p_retailprice AS DECIMAL(12,2))) AS DOUBLE) AS price FROM part LEFT JOIN u ON p = p_partkey AND rn = 1""")
def stock_updates(t):
    products = t.part.select(
        F.col("p_partkey").alias("product_id"), F.col("p_size").alias("stock_quantity"),
        F.col("p_retailprice").cast("decimal(12,2)").alias("price"))
    updates = t.events.select(
        F.col("user_id").alias("product_id"), "ts", "event_id", F.get_json_object("props", "$.k").cast("int").alias("new_stock"),
        F.col("value").cast("decimal(12,2)").alias("new_price"))
    out = st.apply_stock_updates(products, updates, "product_id", "ts", ["event_id"])
    return out.withColumn("price", F.col("price").cast("double"))


# --- checks -------------------------------------------------------------------------------------

CHECKS = {
    "required_present": "id IS NOT NULL AND customer_id IS NOT NULL",
    "no_placeholder": "status IS NOT NULL",
    "dates_parse": "dated IS NOT NULL",
    "numbers_parse": "amount IS NOT NULL",
    "no_negative": "amount >= 0",
    "amount_in_range": "amount BETWEEN 1 AND 400000",
    "status_known": "status IN ('pending', 'processing', 'shipped', 'delivered', 'cancelled', 'returned')",
    "status_lower": "status = lower(status)",
    "customer_exists": "known",
    "no_hidden_space": "raw_date = trim(raw_date)",
}


#: `a` is an earlier near twin of `b`.
TWIN = """a.id < b.id AND a.customer_id = b.customer_id AND a.raw_date = b.raw_date
  AND lower(trim(a.status)) IS NOT DISTINCT FROM lower(trim(b.status)) AND abs(a.amount - b.amount) <= 0.01 + 1e-9"""


@query("expectations", f"""
WITH d AS (SELECT b.id, b.customer_id, {TYPO_CASE.replace('status', 'b.status')} AS status, {CLEAN_NUMBER.replace('total_amount', 'b.total_amount')} AS amount,
  {DATES.replace('order_date', 'b.order_date')} AS dated, b.order_date AS raw_date, c.c_custkey IS NOT NULL AS known
  FROM ({BLANKED.replace("dirty_orders", "crowded_orders")}) b LEFT JOIN customer c ON c.c_custkey = b.customer_id),
u AS (SELECT DISTINCT * FROM d)
SELECT 'no_exact_duplicate' AS "check", count(*) - (SELECT count(*) FROM u) AS failed, count(*) AS total, count(*) = (SELECT count(*) FROM u) AS passed FROM d
UNION ALL SELECT 'no_near_duplicate', count(*) FILTER (WHERE twin), count(*), count(*) FILTER (WHERE twin) = 0
FROM (SELECT EXISTS (SELECT 1 FROM u a WHERE {TWIN}) AS twin FROM u b) x UNION ALL
""" + " UNION ALL ".join(f"""
SELECT '{n}' AS "check", count(*) FILTER (WHERE NOT coalesce({c}, false)) AS failed, count(*) AS total,
  count(*) FILTER (WHERE NOT coalesce({c}, false)) = 0 AS passed FROM d""" for n, c in CHECKS.items()), uses=("crowded_orders",))
def expectations(t):
    rows = placeholders_to_null(t.crowded_orders).withColumns({
        "status": text.fix_typos(F.col("status")),
        "amount": numbers.clean_number(F.col("total_amount")),
        "dated": times.parse_date_formats(F.col("order_date")),
        "raw_date": F.col("order_date"),
    })
    rows = q.with_orphan_flag(rows, "customer_id", t.customer, "c_custkey", "_orphan").withColumn("known", ~F.col("_orphan"))
    return q.expectations(
        rows, {n: F.expr(c) for n, c in CHECKS.items()}, unique=rows.columns,
        near_keys=("id", ["customer_id", "raw_date"], ["status"], "amount"))


_WORDS = ", ".join(f"'{w}'" for w in vocab.PLACEHOLDERS)
#: Conditions under which a row fails.
FAILS = {
    "required_present": f"id IS NULL OR customer_id IS NULL OR status IS NULL OR trim(status) IN ({_WORDS})",
    "dates_formatted": r"NOT regexp_full_match(order_date, '\d{4}-\d{2}-\d{2}( \d{2}:\d{2}:\d{2})?')",
    "numbers_numeric": r"NOT regexp_full_match(trim(total_amount), '-?\d+(\.\d*)?')",
    "no_negative": "num < 0", "rating_in_range": "rating NOT BETWEEN 1 AND 5", "lower_case": "status <> lower(status)",
    "references_exist": "customer_id IS NOT NULL AND customer_id NOT IN (SELECT c_custkey FROM customer)",
    "no_extra_space": "status <> trim(status) OR order_date <> trim(order_date)",
    "totals_add_up": "abs(subtotal - discount_amount + tax_amount + shipping_cost - total) > 0.01", "times_in_order": "shipped_at > delivered_at",
}


@query("cleaning_checklist", f"""
WITH d AS (SELECT *, {CLEAN_NUMBER} AS num FROM checked_orders), u AS (SELECT DISTINCT *, order_date AS raw_date, num AS amount FROM d)
SELECT 'no_exact_duplicate' AS "check", count(*) - (SELECT count(*) FROM u) AS failed, count(*) AS total, count(*) = (SELECT count(*) FROM u) AS passed FROM d
UNION ALL SELECT 'no_near_duplicate', count(*) FILTER (WHERE EXISTS (SELECT 1 FROM u a WHERE {TWIN})), count(*), count(*) FILTER (WHERE EXISTS (SELECT 1 FROM u a WHERE {TWIN})) = 0 FROM u b
UNION ALL """ + " UNION ALL ".join(f"""
SELECT '{n}', count(*) FILTER (WHERE {c}), count(*), count(*) FILTER (WHERE {c}) = 0 FROM d""" for n, c in FAILS.items()), uses=("checked_orders",))
def cleaning_checklist(t):
    """The checks that follow cleaning, on orders that haven't been cleaned."""
    rows = t.checked_orders
    return q.checklist(rows, q.Checklist(
        required=["id", "customer_id", "status"], dates=["order_date"], numbers=["total_amount"], positive=["total_amount"], rating="rating",
        categories=["status"], texts=["status", "order_date"], unique=True, near_keys=("id", ["customer_id", "order_date"], ["status"], "total_amount"),
        references={"customer_id": (t.customer, "c_custkey")}, total=("subtotal", "discount_amount", "tax_amount", "shipping_cost", "total"),
        times=("shipped_at", "delivered_at")))


@query("conversion_failures", f"""
SELECT 'total_amount' AS column_name, count(*) FILTER (WHERE total_amount IS NOT NULL AND {CLEAN_NUMBER} IS NULL) AS failures FROM dirty_orders
UNION ALL SELECT 'order_date', count(*) FILTER (WHERE order_date IS NOT NULL AND {DATES} IS NULL) FROM dirty_orders""", uses=("dirty_orders",))
def conversion_failures(t):
    return q.conversion_failures(t.dirty_orders, {
        "total_amount": numbers.clean_number(F.col("total_amount")),
        "order_date": times.parse_date_formats(F.col("order_date")),
    })


IDENTITIES = {
    "order_total": "abs(subtotal - discount_amount + tax_amount + shipping_cost - total_amount) <= 0.01",
    "item_total": "abs(quantity * unit_price - total_price) <= 0.01",
    "cost_below_price": "cost <= price",
    "shipped_before_delivered": "shipped_at <= delivered_at",
    "delivered_by_estimate": "delivered_at <= estimated",
}
#: Some unit prices are off by two cents, some totals by five, some lines are shipped before the order or late.
SOLD = """SELECT l_extendedprice AS subtotal, l_linenumber * 1.0 AS discount_amount, l_linenumber * 2.0 AS tax_amount, 3.0 AS shipping_cost,
  l_extendedprice + l_linenumber + 3.0 + CASE WHEN l_partkey % 9 = 0 THEN 0.05 ELSE 0.0 END AS total_amount,
  l_quantity AS quantity, CAST(CAST(l_extendedprice / l_quantity AS DECIMAL(14,4)) AS DOUBLE) + CASE WHEN l_suppkey % 7 = 0 THEN 0.02 ELSE 0.0 END AS unit_price, l_extendedprice AS total_price,
  l_discount AS cost, l_tax AS price, o_orderdate AS shipped_at, l_shipdate AS delivered_at, l_shipdate + INTERVAL 3 DAY * (l_suppkey % 4 - 1) AS estimated
FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""


@query("cross_checks", f"WITH s AS ({SOLD}) " + " UNION ALL ".join(f"""
SELECT '{n}' AS "check", count(*) FILTER (WHERE NOT coalesce({c}, false)) AS failed, count(*) AS total,
  count(*) FILTER (WHERE NOT coalesce({c}, false)) = 0 AS passed FROM s""" for n, c in IDENTITIES.items()))
def cross_checks(t):
    checks = q.cross_checks(order_total=True, item_total=True, cost=True, shipped=("shipped_at", "delivered_at"), estimated=("delivered_at", "estimated"))
    return q.expectations(t.sql(SOLD), checks)


@query("defect_matrix", f"""
WITH d AS (SELECT * FROM crowded_orders), u AS (SELECT DISTINCT *, order_date AS raw_date, {CLEAN_NUMBER} AS amount FROM d), w AS (SELECT {', '.join(f"'{x}'" for x in vocab.PLACEHOLDERS if x)}),
a AS (SELECT *, {CLEAN_NUMBER} AS num, {DATES} AS dated FROM d),
m AS (SELECT
  sum((id IS NULL)::INT + (customer_id IS NULL)::INT + (status IS NULL)::INT + (total_amount IS NULL)::INT + (order_date IS NULL)::INT + (category IS NULL)::INT + (_quality_flag IS NULL)::INT) AS "null",
  count(*) FILTER (WHERE trim(status) = '') AS empty,
  count(*) FILTER (WHERE trim(status) IN ({', '.join(f"'{x}'" for x in vocab.PLACEHOLDERS if x)})) AS placeholder,
  count(*) FILTER (WHERE order_date IS NOT NULL AND dated IS NULL) AS bad_date,
  count(*) FILTER (WHERE total_amount IS NOT NULL AND NOT regexp_full_match(trim(total_amount), '-?\\d+\\.?\\d*') AND num IS NOT NULL) AS bad_number,
  count(*) FILTER (WHERE total_amount IS NOT NULL AND num IS NULL) AS mixed_type,
  count(*) FILTER (WHERE lower(trim(status)) IN ({', '.join(f"'{x}'" for x in vocab.STATUS_TYPOS)})) AS typo,
  count(*) FILTER (WHERE num NOT BETWEEN 0 AND 400000) AS out_of_range,
  count(*) FILTER (WHERE status <> lower(status)) AS casing,
  count(*) FILTER (WHERE status <> trim(status)) + count(*) FILTER (WHERE order_date <> trim(order_date)) AS hidden_space,
  count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM d) x) AS duplicate,
  (SELECT count(*) FROM u b WHERE EXISTS (SELECT 1 FROM u a WHERE {TWIN})) AS near_duplicate,
  count(*) FILTER (WHERE customer_id IS NOT NULL AND customer_id NOT IN (SELECT c_custkey FROM customer)) AS orphan_customer_id FROM a)
SELECT 'orders' AS table_name, defect, CAST(cells AS BIGINT) AS cells FROM (SELECT COLUMNS(*)::BIGINT FROM m) UNPIVOT (cells FOR defect IN (COLUMNS(*)))""", uses=("crowded_orders",))
def defect_matrix(t):
    rows = t.crowded_orders
    return q.defect_matrix(
        rows, "orders", text_columns=["status", "order_date"], dates={"order_date": times.parse_date_formats(F.col("order_date"))},
        numbers=["total_amount"], typos=["status"], ranges={"total_amount": (0, 400000)}, unique=rows.columns,
        references={"customer_id": (t.customer, "c_custkey")},
        near_keys=("id", ["customer_id", "order_date"], ["status"], "total_amount"),
    )


CLEANED = f"""
n AS (SELECT id, customer_id, CASE WHEN status IS NULL THEN NULL ELSE {TYPO_CASE.replace('lower(trim(status))', "regexp_replace(lower(trim(status)), '[\\s_]+', '_', 'g')")} END AS status,
  CASE WHEN {CLEAN_NUMBER} > 0 THEN {CLEAN_NUMBER} END AS total_amount, {DATES.split(', CASE WHEN')[0]}) AS order_date FROM ({BLANKED}) b),
k AS (SELECT *, row_number() OVER (PARTITION BY customer_id, order_date, total_amount ORDER BY id) AS rn FROM n),
f AS (SELECT quantile_cont(total_amount, 0.25) AS q1, quantile_cont(total_amount, 0.75) AS q3 FROM k WHERE rn = 1)"""


@query("clean_table", f"""
WITH {CLEANED}
SELECT id, customer_id, status, total_amount, order_date FROM k, f WHERE rn = 1
  AND (total_amount IS NULL OR total_amount BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1))""", uses=("dirty_orders",))
def cleaned(t):
    config = CleaningConfig(
        categorical=["status"], dates=["order_date"], numbers=["total_amount"], positive=["total_amount"],
        dedup=["customer_id", "order_date", "total_amount"], order=["id"], outliers=["total_amount"], typos=vocab.STATUS_TYPOS)
    out = clean_table(t.dirty_orders.drop("category", "_quality_flag"), config)
    return out.select("id", "customer_id", "status", "total_amount", F.col("order_date").cast("timestamp_ntz").alias("order_date"))


@query("duplicate_review", """
WITH n AS (SELECT l_orderkey, l_partkey, count(*) AS n FROM lineitem GROUP BY ALL)
SELECT l_orderkey, l_linenumber, l_partkey, n > 1 AS duplicate_review FROM lineitem JOIN n USING (l_orderkey, l_partkey)""")
def duplicate_review(t):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey")
    return q.with_repeat_flag(rows, ["l_orderkey", "l_partkey"], "duplicate_review")


@query("tag_product_rules", """
WITH n AS (SELECT sku, count(*) AS n FROM dirty_parts WHERE sku IS NOT NULL GROUP BY 1),
p AS (SELECT d.id, d.price, d.stock_quantity, d.sku, coalesce(n.n > 1, false) AS dup,
  CASE d.id % 5 WHEN 0 THEN upper(d.name) WHEN 1 THEN concat(d.name, '...') WHEN 2 THEN concat(d.name, ' ') WHEN 3 THEN substr(d.name, 1, 5) ELSE d.name END AS name,
  TIMESTAMP '2024-01-01' + (d.id % 400) * INTERVAL 1 DAY AS created_at FROM dirty_parts d LEFT JOIN n ON d.sku = n.sku)
SELECT id, array_to_string(list_filter([CASE WHEN price IS NULL THEN 'null_price' END, CASE WHEN price = 0 THEN 'zero_price' END,
  CASE WHEN stock_quantity < 0 THEN 'negative_stock' END, CASE WHEN dup THEN 'duplicate_sku' END,
  CASE WHEN created_at > TIMESTAMP '2024-12-01' THEN 'future_created_at' END, CASE WHEN length(name) BETWEEN 3 AND 8 THEN 'truncated_name' END,
  CASE WHEN ends_with(name, '...') THEN 'cut_name' END, CASE WHEN regexp_matches(lower(name), 'aa|ee|ii|oo|uu') THEN 'doubled_vowel_name' END,
  CASE WHEN name = upper(name) AND lower(name) <> upper(name) THEN 'shouting_name' END, CASE WHEN name <> trim(name) THEN 'hidden_space_name' END], lambda x: x IS NOT NULL), ',') AS reasons
FROM p""", uses=("dirty_parts",))
def tag_product_rules(t):
    """The product rules, on names cut, shouted or padded by turns."""
    name, turn = F.col("name"), F.col("id") % 5
    rows = t.dirty_parts.withColumns({
        "name": F.when(turn == 0, F.upper(name)).when(turn == 1, F.concat(name, F.lit("..."))).when(turn == 2, F.concat(name, F.lit(" ")))
        .when(turn == 3, F.substring(name, 1, 5)).otherwise(name),
        "created_at": F.expr("TIMESTAMP_NTZ '2024-01-01 00:00:00' + make_dt_interval(CAST(id % 400 AS INT))"),
    })
    rows = q.with_repeat_flag(rows, ["sku"], "duplicate_sku")
    rules = [q.null_rule("price"), q.zero_price(), q.negative("stock_quantity", "negative_stock"), q.flagged("duplicate_sku"),
             q.future_created_at(F.expr("TIMESTAMP_NTZ '2024-12-01 00:00:00'")), q.truncated_name(), *q.text_rules("name")]
    return q.tag_rules(rows, rules).select("id", F.array_join("_reasons", ",").alias("reasons"))
