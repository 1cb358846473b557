"""Dirty and change-data views over the given tables, as SQL that Spark and DuckDB both run.

The given tables are clean; these views give every row of them one of the documented defects (by
its key), so that the operators have something to repair. No row is left out.
"""

from __future__ import annotations

VIEWS = {
    # 5% exact duplicates, mixed date shapes, dressed-up and broken numbers, misspelt states,
    # references to customers that do not exist.
    "dirty_orders": """
WITH b AS (
  SELECT o_orderkey, o_custkey, o_orderpriority,
         CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS STRING) AS amt,
         CAST(year(o_orderdate) AS STRING) AS y,
         lpad(CAST(month(o_orderdate) AS STRING), 2, '0') AS m,
         lpad(CAST(day(o_orderdate) AS STRING), 2, '0') AS d
  FROM orders),
r AS (
  SELECT o_orderkey AS id,
    CASE WHEN o_orderkey % 50 = 7 THEN 999990 + o_orderkey % 10 ELSE o_custkey END AS customer_id,
    CASE o_orderkey % 12 WHEN 0 THEN 'PENDING' WHEN 1 THEN ' pending ' WHEN 2 THEN 'pendng' WHEN 3 THEN 'Shipped '
      WHEN 4 THEN 'shiped' WHEN 5 THEN 'DELIVERED' WHEN 6 THEN 'deliverd' WHEN 7 THEN 'N/A' WHEN 8 THEN ''
      WHEN 9 THEN NULL WHEN 10 THEN 'cancelled' ELSE 'procesing' END AS status,
    CASE o_orderkey % 11 WHEN 0 THEN concat('$', amt) WHEN 1 THEN concat(amt, 'USD') WHEN 2 THEN 'abc' WHEN 3 THEN 'NaN'
      WHEN 4 THEN concat('-', amt) WHEN 5 THEN NULL WHEN 6 THEN '#REF!' WHEN 7 THEN '1,234.56' ELSE amt END AS total_amount,
    CASE o_orderkey % 10 WHEN 0 THEN concat(y,'-',m,'-',d) WHEN 1 THEN concat(d,'/',m,'/',y) WHEN 2 THEN concat(m,'-',d,'-',y)
      WHEN 3 THEN concat(d,'.',m,'.',y) WHEN 4 THEN '00/00/0000' WHEN 5 THEN '2024-13-45' WHEN 6 THEN 'not a date'
      WHEN 7 THEN CAST(1700000000 + o_orderkey AS STRING) WHEN 8 THEN 'Jan 5, 2024'
      ELSE concat('  ',y,'-',m,'-',d,' ') END AS order_date,
    o_orderpriority AS category,
    CASE o_orderkey % 20 WHEN 1 THEN 'DIRTY' WHEN 2 THEN 'QUARANTINE' WHEN 3 THEN NULL ELSE 'CLEAN' END AS _quality_flag
  FROM b)
SELECT * FROM r UNION ALL SELECT * FROM r WHERE id % 20 = 0""",
    # Near duplicates under a new id: a blank after the status, dressed amounts a cent or less away, amounts of three
    # decimals that are near one copy but not the other, and copies without a customer, which have no twins.
    "near_orders": """
WITH b AS (SELECT o_orderkey AS id, CASE WHEN o_orderkey % 25 = 3 THEN NULL ELSE o_custkey END AS customer_id, o_orderstatus AS status,
  o_orderdate AS order_date, CAST(o_totalprice AS DECIMAL(12,3)) AS amt FROM orders)
SELECT id, customer_id, status, order_date, CAST(amt AS STRING) AS total_amount FROM b
UNION ALL
SELECT id + 1000000000000000, customer_id, concat(lower(status), ' '), order_date,
  concat('$', CAST(CAST(amt + 0.01 AS DECIMAL(12,3)) AS STRING)) FROM b WHERE id % 50 = 0 OR id % 25 = 3
UNION ALL
SELECT id + 2000000000000000, customer_id, status, order_date, CAST(CAST(amt + 0.02 AS DECIMAL(12,3)) AS STRING) FROM b WHERE id % 50 = 1
UNION ALL
SELECT id + 3000000000000000, customer_id, status, order_date, concat(CAST(CAST(amt + 0.004 AS DECIMAL(12,3)) AS STRING), 'USD') FROM b WHERE id % 50 = 2
UNION ALL
SELECT id + 4000000000000000, customer_id, status, order_date, CAST(CAST(amt + 0.014 AS DECIMAL(12,3)) AS STRING) FROM b WHERE id % 50 = 2""",
    "dirty_parts": """
SELECT p_partkey AS id, p_name AS name, p_brand AS brand,
  CASE p_partkey % 7 WHEN 0 THEN concat('SKU-AB', k) WHEN 1 THEN concat('SKUAB', k) WHEN 2 THEN concat('sku_ab', k)
    WHEN 3 THEN concat('SKU-AB', k, '-VN') WHEN 4 THEN concat('AB', k) WHEN 5 THEN concat('SKU-AB', k, '-HCM') ELSE '' END AS sku,
  CASE p_partkey % 5 WHEN 0 THEN NULL WHEN 1 THEN 0.0 ELSE p_retailprice END AS price,
  CASE p_partkey % 4 WHEN 0 THEN 'true' WHEN 1 THEN 'FALSE' WHEN 2 THEN '--' ELSE NULL END AS is_active,
  CASE WHEN p_partkey % 6 = 0 THEN -(p_partkey % 100) ELSE p_partkey % 100 END AS stock_quantity
FROM (SELECT *, lpad(CAST(p_partkey AS STRING), 6, '0') AS k FROM part) q""",
    "dirty_customers": """
SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance,
  CASE c_custkey % 8 WHEN 0 THEN NULL WHEN 1 THEN concat('user', k, 'gmail.com') WHEN 2 THEN concat('  USER', k, '@MAIL.COM ')
    WHEN 3 THEN 'dup@example.com' ELSE concat('user', k, '@example.com') END AS email,
  CASE WHEN c_custkey % 9 = 0 THEN concat('0', repeat('1234567890', 3)) ELSE concat('0', lpad(k, 9, '1')) END AS phone,
  CASE c_custkey % 6 WHEN 0 THEN 'M' WHEN 1 THEN '  male' WHEN 2 THEN 'FEMALE' WHEN 3 THEN 'female ' WHEN 4 THEN '???' ELSE NULL END AS gender
FROM (SELECT *, CAST(c_custkey AS STRING) AS k FROM customer) q""",
    # Creation of every order, a later update for a third of them, a later delete for some.
    "cdc_orders": """
SELECT id, customer_id, status, total_amount, order_date, __op, __source_ts_ms FROM (
  SELECT o_orderkey AS id, o_custkey AS customer_id, 'pending' AS status, CAST(o_totalprice AS DECIMAL(12,2)) AS total_amount,
         o_orderdate AS order_date, 'c' AS __op, 1700000000000 + o_orderkey * 10000 AS __source_ts_ms FROM orders
  UNION ALL SELECT o_orderkey, o_custkey, 'shipped', CAST(o_totalprice AS DECIMAL(12,2)), o_orderdate, 'u',
         1700000000000 + o_orderkey * 10000 + 1000 FROM orders WHERE o_orderkey % 3 = 0
  UNION ALL SELECT o_orderkey, o_custkey, 'shipped', CAST(o_totalprice AS DECIMAL(12,2)), o_orderdate, 'd',
         1700000000000 + o_orderkey * 10000 + 2000 FROM orders WHERE o_orderkey % 30 = 0) u""",
    # One change message per line; the same line key may come several times.
    "cdc_items": """
SELECT l_orderkey * 10 + l_linenumber AS id, l_orderkey AS order_id, l_partkey AS product_id,
       CAST(l_quantity AS INT) AS quantity, CAST(floor(l_extendedprice / l_quantity) AS DECIMAL(12,2)) AS unit_price,
       CAST(l_extendedprice AS DECIMAL(12,2)) AS total_price, 'c' AS __op,
       1700000000000 + l_partkey * 100000 + l_suppkey * 100 + CAST(l_quantity AS BIGINT) AS __source_ts_ms
FROM lineitem""",
    # Gateway events out of the event stream: payments by purchases, status steps by clicks.
    "gateway": """
SELECT event_id, ts, user_id, event_type, value,
       CASE event_type WHEN 'purchase' THEN 'payment.created' WHEN 'click' THEN 'payment.status_updated'
         WHEN 'signup' THEN 'shipping.created' WHEN 'view' THEN 'shipping.status_updated'
         ELSE 'order.delivered_notification' END AS kind,
       concat('TXN-', CAST(user_id AS STRING), '-', CAST(day(ts) AS STRING)) AS txn
FROM events""",
}

# The dirty orders, and near duplicates of some under a new id with a dressed amount.
VIEWS["crowded_orders"] = f"""
WITH dirty AS ({VIEWS["dirty_orders"]})
SELECT * FROM dirty UNION ALL
SELECT id + 1000000000000000, customer_id, status, concat('$', total_amount), order_date, category, _quality_flag
FROM (SELECT DISTINCT * FROM dirty) x WHERE id % 11 > 7 AND id % 8 = 1"""

# Those with a rating, the parts of a total and two dates, some of them wrong.
VIEWS["checked_orders"] = f"""
WITH crowded AS ({VIEWS["crowded_orders"]})
SELECT id, customer_id, status, total_amount, order_date, CAST(id % 8 AS INT) AS rating, CAST(id % 1000 AS DECIMAL(12,2)) AS subtotal,
  CAST(id % 7 AS DECIMAL(12,2)) AS discount_amount, CAST(id % 5 AS DECIMAL(12,2)) AS tax_amount, CAST(id % 3 AS DECIMAL(12,2)) AS shipping_cost,
  CAST(id % 1000 - id % 7 + id % 5 + id % 3 + CASE WHEN id % 90 = 4 THEN 1 ELSE 0 END AS DECIMAL(12,2)) AS total,
  CAST(concat('2024-0', CAST(1 + id % 9 AS STRING), '-1', CAST(id % 9 AS STRING)) AS DATE) AS shipped_at,
  CAST(concat('2024-0', CAST(1 + (id + CASE WHEN id % 40 = 3 THEN 8 ELSE 0 END) % 9 AS STRING), '-2', CAST(id % 9 AS STRING)) AS DATE) AS delivered_at
FROM crowded"""
