"""Parsing, missing values and scalar repair."""

from __future__ import annotations

from pyspark.sql import functions as F

from siltstone import schemas, vocab
from siltstone.functions import numbers, text, times
from siltstone.operators import missing, parse, quantiles
from siltstone.operators.dedup import latest_per_key
from siltstone.plans.cleaning import CleaningConfig, clean_table
from workload.registry import query


def _ntz(c):
    return c.cast("timestamp_ntz")


# --- parsing ------------------------------------------------------------------------------------


def order_changes(t):
    """Landing records: order changes and customer rows, as JSON text on their topics."""
    orders = t.cdc_orders.withColumn("order_date", F.unix_millis(F.col("order_date").cast("timestamp"))).select(
        F.to_json(F.struct("*")).alias("raw_data"), F.lit("erp.public.orders").alias("_source_topic"))
    customers = t.dirty_customers.select(
        F.to_json(F.struct("*")).alias("raw_data"), F.lit("erp.public.customers").alias("_source_topic"))
    return orders.unionByName(customers)


CDC_OUT = ["id", "customer_id", "status", "total_amount", "__op", "__source_ts_ms"]


def _cdc_out(df):
    return df.withColumn("total_amount", numbers.to_money(F.col("total_amount")).cast("double")).select(*CDC_OUT)


@query("cdc_parse", """
SELECT id, customer_id, status, CAST(total_amount AS DOUBLE) AS total_amount, __op, __source_ts_ms
FROM cdc_orders WHERE __op <> 'd'""", uses=("cdc_orders",))
def cdc_parse(t):
    return _cdc_out(parse.parse_cdc(order_changes(t), "erp.public.orders", schemas.CDC["orders"], deletes="drop"))


@query("cdc_current_state", """
SELECT id, customer_id, status, CAST(total_amount AS DOUBLE) AS total_amount, __op, __source_ts_ms
FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY __source_ts_ms DESC) AS rn FROM cdc_orders) c
WHERE rn = 1 AND __op <> 'd'""", uses=("cdc_orders",))
def cdc_current_state(t):
    rows = parse.parse_cdc(order_changes(t), "erp.public.orders", schemas.CDC["orders"])
    return _cdc_out(parse.drop_deletes(latest_per_key(rows, ["id"], "__source_ts_ms")))


LIFECYCLE_KIND = "CASE event_type WHEN 'view' THEN 'product.created' WHEN 'click' THEN 'product.updated' ELSE 'product.stock_updated' END"


def flat_events(t):
    return t.events.select(
        F.to_json(F.struct(
            F.lit("warehouse").alias("_source_system"),
            F.concat(F.lit("e-"), F.col("event_id")).alias("_event_id"),
            F.expr(LIFECYCLE_KIND).alias("_event_type"),
            F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("_ingested_at"),
            F.col("value").cast("decimal(12,2)").alias("price"),
            F.concat(F.lit("sku_"), F.col("user_id")).alias("sku"),
        )).alias("raw_data")
    )


@query("flat_envelope", f"""
SELECT concat('e-', event_id) AS _event_id, {LIFECYCLE_KIND} AS _event_type, ts AS _ingested_at,
  concat('SKU-', user_id) AS sku, CAST(CAST(value AS DECIMAL(12,2)) AS DOUBLE) AS price
FROM events WHERE event_type IN ('view', 'click')""")
def flat_envelope(t):
    rows = parse.keep_event_types(
        parse.parse_flat_envelope(flat_events(t), schemas.WAREHOUSE_LIFECYCLE), vocab.PRODUCT_LIFECYCLE_EVENTS)
    return rows.select(
        "_event_id", "_event_type", _ntz(times.iso_ts(F.col("_ingested_at"))).alias("_ingested_at"),
        text.sku_simple(F.col("sku")).alias("sku"), numbers.to_money(F.col("price")).cast("double").alias("price"),
    )


def _envelope(event_type, payload):
    return F.to_json(F.struct(
        F.lit("payment_gw").alias("_source_system"),
        F.concat(F.lit("e-"), F.col("event_id")).alias("_event_id"),
        event_type.alias("_event_type"),
        F.lit("c").alias("_op_type"),
        F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("_ingested_at"),
        F.lit("CLEAN").alias("_quality_flag"),
        payload.alias("payload"),
    )).alias("raw_data")


@query("nested_envelope", """
SELECT concat('e-', event_id) AS _event_id, event_type AS _event_type, ts AS _ingested_at,
  CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events""")
def nested_envelope(t):
    bronze = t.events.select(_envelope(F.col("event_type"), F.from_json("props", "k bigint")))
    rows = parse.parse_nested_envelope(bronze)
    return rows.select(
        "_event_id", "_event_type", _ntz(times.iso_ts(F.col("_ingested_at"))).alias("_ingested_at"),
        F.get_json_object("payload_json", "$.k").cast("bigint").alias("k"),
    )


@query("payload_parse", """
SELECT concat('e-', event_id) AS _event_id, event_id AS payment_id, user_id AS order_id,
  CAST(CAST(value AS DECIMAL(12,2)) AS DOUBLE) AS amount, txn AS transaction_id,
  CAST(json_extract_string(props, '$.k') AS BIGINT) AS meta_k
FROM (SELECT g.*, e.props FROM gateway g JOIN events e USING (event_id)) j WHERE event_type = 'purchase'""", uses=("gateway",))
def payload_parse(t):
    rows = t.gateway.join(t.events.select("event_id", "props"), "event_id")
    payload = F.struct(
        F.col("event_id").alias("payment_id"), F.col("user_id").alias("order_id"),
        F.col("value").cast("decimal(12,2)").alias("amount"), F.col("txn").alias("transaction_id"),
        F.from_json("props", "k bigint").alias("gateway_meta"),
    )
    kind = F.when(F.col("event_type") == "purchase", "payment.created").otherwise("shipping.created")
    env = parse.parse_nested_envelope(rows.select(_envelope(kind, payload)))
    parsed = parse.parse_payload(env, "payment.", schemas.PAYLOAD["payment"])
    return parsed.select(
        "_event_id", "payment_id", "order_id", numbers.to_money(F.col("amount")).cast("double").alias("amount"),
        "transaction_id", F.get_json_object("gateway_meta", "$.k").cast("bigint").alias("meta_k"),
    )


@query("positive_filter", "SELECT * FROM customer WHERE c_acctbal > 0")
def positive_filter(t):
    return parse.require_positive(t.customer, "c_acctbal")


@query("email_valid", r"""
SELECT id, lower(trim(email)) AS email, regexp_full_match(lower(trim(email)), '[^@\s]+@[^@\s]+\.[^@\s]+') AS valid
FROM dirty_customers""", uses=("dirty_customers",))
def email_valid(t):
    return t.dirty_customers.select(
        "id", text.lower_trim(F.col("email")).alias("email"), text.is_email(F.col("email")).alias("valid"))


# --- missing values -----------------------------------------------------------------------------

WORDS = ", ".join(f"'{w}'" for w in vocab.PLACEHOLDERS)


def _blank(c: str) -> str:
    return f"CASE WHEN trim({c}) IN ({WORDS}) THEN NULL ELSE {c} END"


BLANKED = "SELECT id, customer_id, " + ", ".join(
    f"{_blank(c)} AS {c}" for c in ("status", "total_amount", "order_date", "category", "_quality_flag")) + " FROM dirty_orders"


@query("placeholders_to_null", BLANKED, uses=("dirty_orders",))
def placeholders_to_null(t):
    return missing.placeholders_to_null(t.dirty_orders)


@query("null_profile", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL" + (f" OR {c} = ''" if s else "") + ") AS missing FROM dirty_orders"
    for c, s in (("id", 0), ("customer_id", 0), ("status", 1), ("total_amount", 1), ("order_date", 1), ("category", 1), ("_quality_flag", 1))),
    uses=("dirty_orders",))
def null_profile(t):
    return missing.null_profile(t.dirty_orders)


NUMBER = "TRY_CAST(trim(regexp_replace(total_amount, '\\$|,|USD', '', 'g')) AS DOUBLE)"
CLEAN_NUMBER = f"CASE WHEN isnan({NUMBER}) OR isinf({NUMBER}) THEN NULL ELSE {NUMBER} END"


def _amounts(t):
    return t.dirty_orders.withColumn("amount", numbers.clean_number(F.col("total_amount")))


@query("fill_constants", f"""
SELECT id, coalesce(status, 'unknown') AS status, coalesce({CLEAN_NUMBER}, 0.0) AS amount FROM dirty_orders""", uses=("dirty_orders",))
def fill_constants(t):
    return missing.fill_constants(_amounts(t).select("id", "status", "amount"), {"status": "unknown", "amount": 0.0})


@query("impute_median", f"""
WITH n AS (SELECT id, CAST({CLEAN_NUMBER} AS DECIMAL(12,2)) AS amount FROM dirty_orders)
SELECT id, coalesce(CAST(amount AS DOUBLE), (SELECT quantile_cont(CAST(amount AS DOUBLE), 0.5) FROM n)) AS amount FROM n""", uses=("dirty_orders",))
def impute_median(t):
    rows = _amounts(t).select("id", F.col("amount").cast("decimal(12,2)").cast("double").alias("amount"))
    return missing.impute_median(rows, ["amount"])


@query("impute_group_median", f"""
WITH n AS (SELECT id, CASE WHEN id % 6 <> 0 THEN category END AS category, CAST(CAST({CLEAN_NUMBER} AS DECIMAL(12,2)) AS DOUBLE) AS amount FROM dirty_orders),
m AS (SELECT category, quantile_cont(amount, 0.5) AS med FROM n GROUP BY category)
SELECT id, n.category, coalesce(amount, med) AS amount FROM n JOIN m ON n.category IS NOT DISTINCT FROM m.category""", uses=("dirty_orders",))
def impute_group_median(t):
    """Rows without a category are a group."""
    category = F.when(F.col("id") % 6 != 0, F.col("category")).alias("category")
    rows = _amounts(t).select("id", category, F.col("amount").cast("decimal(12,2)").cast("double").alias("amount"))
    return missing.impute_median(rows, ["amount"], by=["category"])


@query("quantile_small_values", """
WITH v AS (SELECT l_returnflag, l_tax / 1000 + l_quantity / 1e7 AS v FROM lineitem)
SELECT l_returnflag, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS q2, quantile_cont(v, 0.75) AS q3 FROM v GROUP BY 1""")
def quantile_small_values(t):
    rows = t.lineitem.select("l_returnflag", (F.col("l_tax") / 1000 + F.col("l_quantity") / 1e7).alias("v"))
    found = quantiles.exact_quantiles(rows, "v", [0.25, 0.5, 0.75], ["l_returnflag"])
    return found.select("l_returnflag", *[F.col("quantiles")[i].alias(f"q{i + 1}") for i in range(3)])


@query("quantile_big_integers", """
WITH v AS (SELECT 1700000000000000 + o_orderkey * 1000003 AS v FROM orders)
SELECT quantile_cont(CAST(v AS DOUBLE), 0.25) AS q1, quantile_cont(CAST(v AS DOUBLE), 0.5) AS q2, quantile_cont(CAST(v AS DOUBLE), 0.75) AS q3 FROM v""")
def quantile_big_integers(t):
    rows = t.orders.select((F.lit(1700000000000000) + F.col("o_orderkey").cast("bigint") * 1000003).alias("v"))
    found = quantiles.exact_quantiles(rows, "v", [0.25, 0.5, 0.75])
    return found.select(*[F.col("quantiles")[i].alias(f"q{i + 1}") for i in range(3)])


SMALL = """SELECT o_orderkey AS id, CASE WHEN o_orderkey % 97 = 0 THEN '1.9' ELSE concat('1.00', CAST(o_orderkey % 7 + 1 AS STRING)) END AS amount FROM orders"""


@query("clean_table_small_values", f"""
WITH n AS (SELECT id, CAST(amount AS DOUBLE) AS amount FROM ({SMALL}) s),
f AS (SELECT quantile_cont(amount, 0.25) AS q1, quantile_cont(amount, 0.75) AS q3 FROM n)
SELECT id, amount FROM n, f WHERE amount BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)""")
def clean_table_small_values(t):
    return clean_table(t.sql(SMALL), CleaningConfig(numbers=("amount",), outliers=("amount",)))


@query("drop_incomplete", f"""
SELECT * FROM ({BLANKED}) b WHERE (CASE WHEN id IS NULL THEN 0 ELSE 1 END) + (CASE WHEN customer_id IS NULL THEN 0 ELSE 1 END)
 + (CASE WHEN status IS NULL THEN 0 ELSE 1 END) + (CASE WHEN total_amount IS NULL THEN 0 ELSE 1 END)
 + (CASE WHEN order_date IS NULL THEN 0 ELSE 1 END) + (CASE WHEN category IS NULL THEN 0 ELSE 1 END)
 + (CASE WHEN _quality_flag IS NULL THEN 0 ELSE 1 END) >= 6""", uses=("dirty_orders",))
def drop_incomplete(t):
    return missing.drop_incomplete(missing.placeholders_to_null(t.dirty_orders), 0.9)


@query("drop_missing_keys", f"SELECT * FROM ({BLANKED}) b WHERE status IS NOT NULL AND total_amount IS NOT NULL", uses=("dirty_orders",))
def drop_missing_keys(t):
    return missing.drop_missing_keys(missing.placeholders_to_null(t.dirty_orders), ["status", "total_amount"])


# --- text ---------------------------------------------------------------------------------------


@query("trim_text", r"""
SELECT doc_id, md5(trim(regexp_replace(text, '[\t\n\r]', '', 'g'))) AS digest, trim(regexp_replace(source, '[\t\n\r]', '', 'g')) AS source
FROM documents""")
def trim_text(t):
    return missing.trim_text(t.documents).select("doc_id", F.md5("text").alias("digest"), "source")


@query("trim_dirty", r"""
SELECT id, trim(status) AS status, trim(order_date) AS order_date FROM dirty_orders""", uses=("dirty_orders",))
def trim_dirty(t):
    return missing.trim_text(t.dirty_orders).select("id", "status", "order_date")


@query("case_normalise", """
SELECT p_partkey, lower(trim(p_name)) AS lowered, upper(trim(p_name)) AS raised,
  array_to_string(list_transform(string_split(lower(trim(p_name)), ' '), lambda w: upper(w[1]) || w[2:]), ' ') AS titled FROM part""")
def case_normalise(t):
    c = F.col("p_name")
    return t.part.select("p_partkey", text.lower_trim(c).alias("lowered"), text.upper_trim(c).alias("raised"), text.title_trim(c).alias("titled"))


@query("snake_category", r"""
SELECT id, regexp_replace(lower(trim(category)), '[\s_]+', '_', 'g') AS category FROM dirty_orders""", uses=("dirty_orders",))
def snake_category(t):
    return t.dirty_orders.select("id", text.snake_category(F.col("category")).alias("category"))


@query("sku_simple", r"SELECT id, regexp_replace(upper(trim(sku)), '[_\s]', '-', 'g') AS sku FROM dirty_parts", uses=("dirty_parts",))
def sku_simple(t):
    return t.dirty_parts.select("id", text.sku_simple(F.col("sku")).alias("sku"))


@query("sku_canonical", r"""
WITH b AS (SELECT id, sku, regexp_replace(regexp_replace(regexp_replace(upper(trim(sku)), '^SKU[-_]?', ''), '-[A-Z]{2,3}$', ''), '[^A-Z0-9]', '', 'g') AS body FROM dirty_parts)
SELECT id, sku, CASE WHEN sku IS NULL OR sku = '' THEN '' WHEN body = '' THEN sku ELSE 'SKU-' || body END AS canonical,
  CASE WHEN sku IS NULL OR sku = '' OR body = '' THEN false ELSE 'SKU-' || body <> upper(sku) END AS changed FROM b""", uses=("dirty_parts",))
def sku_canonical(t):
    return t.dirty_parts.select("id", "sku", text.sku_canonical(F.col("sku")).alias("s")).select("id", "sku", "s.*")


@query("phone_truncate", "SELECT id, substr(phone, 1, 20) AS phone FROM dirty_customers", uses=("dirty_customers",))
def phone_truncate(t):
    return t.dirty_customers.select("id", text.phone_truncate(F.col("phone")).alias("phone"))


STATUS_LIST = ", ".join(f"'{s}'" for s in vocab.ORDER_STATUSES)


@query("enum_normalise", f"""
SELECT id, CASE WHEN upper(trim(status)) IN ({STATUS_LIST}) THEN upper(trim(status)) END AS status FROM dirty_orders""", uses=("dirty_orders",))
def enum_normalise(t):
    return t.dirty_orders.select("id", text.enum_or_null(F.col("status"), vocab.ORDER_STATUSES).alias("status"))


TYPO_CASE = "CASE lower(trim(status)) " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in vocab.STATUS_TYPOS.items()) + " ELSE lower(trim(status)) END"


@query("typo_map", f"SELECT id, {TYPO_CASE} AS status FROM dirty_orders", uses=("dirty_orders",))
def typo_map(t):
    return t.dirty_orders.select("id", text.fix_typos(F.col("status")).alias("status"))


VALID = [s.lower() for s in vocab.ORDER_STATUSES]


@query("fuzzy_enum", f"""
WITH w AS (SELECT DISTINCT lower(trim(status)) AS word FROM dirty_orders WHERE status IS NOT NULL),
v AS (SELECT * FROM (VALUES {', '.join(f"({i}, '{s}')" for i, s in enumerate(VALID))}) x(pos, valid)),
b AS (SELECT word, valid, row_number() OVER (PARTITION BY word ORDER BY levenshtein(word, valid), pos) AS rn,
  levenshtein(word, valid) AS dist FROM w, v)
SELECT d.id, CASE WHEN b.dist <= 2 THEN b.valid END AS status FROM dirty_orders d LEFT JOIN b ON lower(trim(d.status)) = b.word AND b.rn = 1""", uses=("dirty_orders",))
def fuzzy_enum(t):
    return t.dirty_orders.select("id", text.nearest_word(F.col("status"), VALID, 2).alias("status"))


# --- numbers ------------------------------------------------------------------------------------


@query("clean_number", f"SELECT id, {CLEAN_NUMBER} AS amount, round({CLEAN_NUMBER}, 2) AS rounded FROM dirty_orders", uses=("dirty_orders",))
def clean_number(t):
    return _amounts(t).select("id", "amount", numbers.round_money(F.col("amount")).alias("rounded"))


@query("numeric_or_null", r"""
SELECT id, CASE WHEN regexp_full_match(total_amount, '-?\d+\.?\d*') THEN TRY_CAST(total_amount AS DOUBLE) END AS amount FROM dirty_orders""", uses=("dirty_orders",))
def numeric_or_null(t):
    return t.dirty_orders.select("id", numbers.numeric_or_null(F.col("total_amount")).alias("amount"))


@query("to_money", "SELECT id, CAST(TRY_CAST(total_amount AS DECIMAL(12,2)) AS DOUBLE) AS amount FROM dirty_orders", uses=("dirty_orders",))
def to_money(t):
    return t.dirty_orders.select("id", numbers.to_money(F.col("total_amount")).cast("double").alias("amount"))


@query("non_negative", """
SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN c_acctbal END AS or_null, abs(c_acctbal) AS magnitude FROM customer""")
def non_negative(t):
    c = F.col("c_acctbal")
    return t.customer.select("c_custkey", numbers.non_negative(c).alias("or_null"), numbers.non_negative(c, "abs").alias("magnitude"))


@query("in_range", """
SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_quantity BETWEEN 1 AND 25 THEN l_quantity END AS l_quantity FROM lineitem""")
def in_range(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", numbers.in_range(F.col("l_quantity"), 1, 25).alias("l_quantity"))


@query("to_bool", "SELECT id, TRY_CAST(is_active AS BOOLEAN) AS is_active FROM dirty_parts", uses=("dirty_parts",))
def to_bool(t):
    return t.dirty_parts.select("id", numbers.to_bool(F.col("is_active")).alias("is_active"))


# --- times --------------------------------------------------------------------------------------


@query("epoch_ms", """
SELECT id, __op, make_timestamp(__source_ts_ms * 1000) AS changed_at, make_timestamp((__source_ts_ms // 1000) * 1000000) AS changed_s,
  CAST(make_timestamp(__source_ts_ms * 1000) AS DATE) AS changed_on, CASE WHEN id % 3 = 0 THEN NULL ELSE make_timestamp(__source_ts_ms * 1000) END AS odd_ms,
  CASE WHEN id % 3 = 1 THEN NULL ELSE make_timestamp((__source_ts_ms // 1000) * 1000000) END AS odd_s FROM cdc_orders""", uses=("cdc_orders",))
def epoch_ms(t):
    """Numbers that no time can hold, of either sign, are NULL."""
    ms, s = F.col("__source_ts_ms"), F.floor(F.col("__source_ts_ms") / 1000)
    far = F.lit((1 << 63) - 1)
    return t.cdc_orders.select(
        "id", "__op", _ntz(times.epoch_to_ts(ms)).alias("changed_at"), _ntz(times.epoch_to_ts(s, "s")).alias("changed_s"),
        times.epoch_to_ts(F.floor(ms / 86400000), "d").alias("changed_on"),
        _ntz(times.epoch_to_ts(F.when(F.col("id") % 3 == 0, far - F.col("id")).otherwise(ms))).alias("odd_ms"),
        _ntz(times.epoch_to_ts(F.when(F.col("id") % 3 == 1, F.col("id") - far).otherwise(s), "s")).alias("odd_s"),
    )


EPOCH_TEXT = r"CASE WHEN regexp_full_match(trim(order_date), '\d+') AND TRY_CAST(trim(order_date) AS BIGINT) <= 9223372036853 THEN make_timestamp(TRY_CAST(trim(order_date) AS BIGINT) * 1000000) END"
DATES = f"coalesce(try_strptime(trim(order_date), ['%Y-%m-%d', '%d/%m/%Y', '%m-%d-%Y', '%d.%m.%Y', '%b %-d, %Y']), {EPOCH_TEXT})"


@query("mixed_ts", f"""
WITH s AS (SELECT id, CASE WHEN id % 10 = 0 THEN concat(order_date, ' 12:34:56') ELSE order_date END AS order_date FROM dirty_orders)
SELECT id, coalesce(try_strptime(trim(order_date), '%Y-%m-%d %H:%M:%S'), {EPOCH_TEXT}) AS at FROM s""", uses=("dirty_orders",))
def mixed_ts(t):
    stamped = F.when(F.col("id") % 10 == 0, F.concat("order_date", F.lit(" 12:34:56"))).otherwise(F.col("order_date"))
    return t.dirty_orders.select("id", _ntz(times.parse_mixed_ts(stamped)).alias("at"))


@query("date_formats", f"SELECT id, {DATES} AS at FROM dirty_orders", uses=("dirty_orders",))
def date_formats(t):
    return t.dirty_orders.select("id", _ntz(times.parse_date_formats(F.col("order_date"))).alias("at"))


@query("unparsed_dates", f"SELECT id, order_date FROM dirty_orders WHERE order_date IS NOT NULL AND {DATES} IS NULL", uses=("dirty_orders",))
def unparsed_dates(t):
    parsed = t.dirty_orders.withColumn("at", times.parse_date_formats(F.col("order_date")))
    return times.unparsed(parsed, "order_date", "at").select("id", "order_date")


@query("iso_ts", "SELECT event_id, CASE WHEN event_type <> 'error' THEN ts END AS at FROM events")
def iso_ts(t):
    written = F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    raw = F.when(F.col("event_type") == "error", "not a time").otherwise(written)
    return t.events.select("event_id", _ntz(times.iso_ts(raw)).alias("at"))
