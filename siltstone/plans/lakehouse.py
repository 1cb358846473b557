"""Whole runs: bronze, silver, gold. Each step reads and writes folders below one root."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siltstone import schemas, vocab
from siltstone.operators import quality as q
from siltstone.operators.quality import dead_letters
from siltstone.operators.reports import monthly_revenue
from siltstone.operators.status import apply_delivery_notices, apply_stock_updates
from siltstone.plans import gold, silver
from siltstone.sources.bronze import read_topics, to_bronze
from siltstone.sources.compaction import TARGET_BYTES, compact, read_packed
from siltstone.sources.tables import ensure_database, publish
from siltstone.sources.versions import VersionedTable
from siltstone.streaming.flows import append_bronze

BUCKETS = 64

# silver table -> (key of its rows, type of the key, whether records carry it in their payload, its event types or how they begin)
KEYS: dict[str, tuple[str, str, bool, str | Sequence[str] | None]] = {
    "orders": ("id", "bigint", False, None),
    "customers": ("id", "bigint", False, None),
    "order_items": ("id", "bigint", False, None),
    "products": ("id", "bigint", False, None),
    "warehouse_events": ("sku", "string", False, vocab.PRODUCT_LIFECYCLE_EVENTS),
    "payments": ("transaction_id", "string", True, "payment."),
    "shipping": ("tracking_number", "string", True, "shipping."),
    "reviews": ("review_id", "bigint", True, "review."),
    "feedback": ("feedback_id", "bigint", True, "feedback."),
}

# silver table -> (landing table, recipe, label in the dead-letter table)
ENTITIES: dict[str, tuple[str, Callable[[DataFrame], DataFrame], str]] = {
    "orders": ("erp_raw", silver.orders, "erp.orders"),
    "customers": ("erp_raw", silver.customers, "erp.customers"),
    "order_items": ("erp_raw", silver.order_items, "erp.order_items"),
    "products": ("erp_raw", silver.products, "erp.products"),
    "warehouse_events": ("wh_raw", silver.warehouse_products, "warehouse.products"),
    "payments": ("pay_raw", silver.payments, "payment.payments"),
    "shipping": ("pay_raw", silver.shipping, "payment.shipping"),
    "reviews": ("pay_raw", silver.reviews, "payment.reviews"),
    "feedback": ("pay_raw", silver.feedback, "payment.feedback"),
}


def run_bronze(spark: SparkSession, root: str, *, servers: str | None = None, files: str | None = None) -> dict[str, int]:
    """Drain every topic into its landing table; rows read per table."""
    landed = {}
    for sink, pattern in vocab.TOPIC_ROUTES.items():
        messages = read_topics(spark, pattern, servers=servers, files=files)
        landed[sink] = append_bronze(to_bronze(messages), f"{root}/bronze/{sink}", f"{root}/_checkpoints/bronze/{sink}")
    return landed


def read_bronze(spark: SparkSession, root: str, sink: str, since: str | None = None) -> DataFrame:
    """A landing table, packed or not, from `since` (a day) on: older folders are not read."""
    return read_packed(spark, f"{root}/bronze/{sink}", f"{root}/bronze_packed/{sink}", since)


def compact_bronze(spark: SparkSession, root: str, target: int = TARGET_BYTES) -> dict[str, int | None]:
    """Packs what has landed since the last time; the new version of each landing table that has anything new."""
    return {sink: compact(spark, f"{root}/bronze/{sink}", f"{root}/bronze_packed/{sink}", target) for sink in vocab.TOPIC_ROUTES}


def silver_table(spark: SparkSession, root: str, entity: str) -> VersionedTable:
    return VersionedTable(spark, f"{root}/silver/{entity}")


def history_table(spark: SparkSession, root: str, entity: str) -> VersionedTable:
    """The landing records of an entity by key bucket and day."""
    return VersionedTable(spark, f"{root}/silver_history/{entity}")


def read_silver(spark: SparkSession, root: str, entity: str) -> DataFrame:
    """All rows of a silver entity, of whatever route, with the columns that its last run gave it; none before its first run."""
    table = silver_table(spark, root, entity)
    if newest := table.versions():
        return table.read(version=newest[-1]).drop("_bucket")
    _, recipe, _ = ENTITIES[entity]
    return spark.createDataFrame([], recipe(spark.createDataFrame([], schemas.BRONZE)).schema)


def read_routed(spark: SparkSession, root: str, entity: str, route: str) -> DataFrame:
    """One branch of a silver entity. `_route` is a partition column: other branches are not read."""
    return read_silver(spark, root, entity).filter(F.col("_route") == route)


def entity_records(bronze: DataFrame, entity: str) -> DataFrame:
    """The landing records that an entity's recipe reads, those without a key included."""
    sink, _, _ = ENTITIES[entity]
    if sink == "erp_raw":
        return bronze.filter(F.col("_source_topic") == f"erp.public.{entity}")
    kind, types = F.from_json("raw_data", "_event_type string")["_event_type"], KEYS[entity][3]
    return bronze.filter(F.startswith(kind, F.lit(types)) if isinstance(types, str) else kind.isin(*types))


def record_key(entity: str) -> Column:
    """The key that a landing record gives the entity, spelled as in the entity; NULL where it has none."""
    key, kind, nested, _ = KEYS[entity]
    record = F.col("raw_data")
    if nested:
        record = F.from_json(record, "payload string")["payload"]
    return silver.clean_key(key, F.from_json(record, f"{key} {kind}")[key])


def key_bucket(key: Column, buckets: int) -> Column:
    """The same for equal keys however they are typed; records without a key share one."""
    return F.pmod(F.xxhash64(key.cast("string")), F.lit(buckets)).cast("int")


def _signatures(history: dict | None) -> dict[str, str]:
    """What each bucket holds, by count and checksum of its days."""
    found: dict[str, list[str]] = {}
    for part in history["parts"] if history else []:
        found.setdefault(str(part["at"]["_bucket"]), []).append(f"{part['at']['ingest_date']}:{part['rows']}:{part['checksum']}")
    return {bucket: "/".join(sorted(days)) for bucket, days in found.items()}


def update_silver(spark: SparkSession, root: str, entity: str, since: str | None = None, buckets: int = BUCKETS) -> list[int]:
    """Brings an entity up to date with the landing folders, all of them or those from `since` (a day) on; the buckets worked out again.

    Landing records go to the entity's history, by bucket of their key and by day; only folders from `since` on are read,
    and their days replace the same days there, so that a repeated run adds nothing. Then each bucket whose history isn't what
    the stored entity was made of is worked out anew from its whole history, and replaces that bucket of the entity. A run that
    died between the two steps is made good by the next one. Other buckets are neither read nor written. Without
    `since`, or with another number of buckets than before, every bucket is worked out.
    """
    sink, recipe, _ = ENTITIES[entity]
    history, table = history_table(spark, root, entity), silver_table(spark, root, entity)
    known, made = history.manifest(), table.manifest()
    if not known or not made or known["about"]["buckets"] != buckets:
        since = None
    records = entity_records(read_bronze(spark, root, sink, since), entity).withColumn("_bucket", key_bucket(record_key(entity), buckets))
    later = (lambda at: True) if since is None else (lambda at: at["ingest_date"] is not None and at["ingest_date"] >= since)
    history.replace(records, ["_bucket", "ingest_date"], gone=later, about={"buckets": buckets})

    now = _signatures(history.manifest())
    before = {} if since is None else made["about"]["history"]
    touched = {int(b) for b in now.keys() | before.keys() if now.get(b) != before.get(b)}
    if since is not None and not touched:
        return []
    changed = recipe(history.read(only=lambda at: at["_bucket"] in touched).drop("_bucket"))
    changed = changed.withColumn("_bucket", key_bucket(F.col(KEYS[entity][0]), buckets))
    table.replace(changed, ["_bucket"], ["_route"], gone=lambda at: since is None or at["_bucket"] in touched, about={"history": now})
    return sorted(touched)


def run_silver(
    spark: SparkSession, root: str, now: Column | None = None, since: str | None = None, entities: Sequence[str] = tuple(ENTITIES),
    buckets: int = BUCKETS,
) -> dict[str, list[int]]:
    """Rebuild the silver entities and the dead-letter table; with `since` (a day) only the key buckets that later landings touch.

    Each entity is computed once and written once, split into `_route` folders; the dead-letter
    table is then assembled from the (small) rejected folders. Returns the buckets worked out of each entity.
    """
    now = F.current_timestamp() if now is None else now
    touched = {entity: update_silver(spark, root, entity, since, buckets) for entity in entities}
    there = [e for e in ENTITIES if silver_table(spark, root, e).versions()]
    rejects = {ENTITIES[e][2]: read_routed(spark, root, e, silver.DEAD_LETTER) for e in there}
    VersionedTable(spark, f"{root}/silver/dlq").overwrite(dead_letters(rejects, now))
    return touched


def current_orders(spark: SparkSession, root: str) -> DataFrame:
    """Accepted orders with the delivery notices of the gateway applied; the orders themselves stay as their source has them."""
    notices = silver.delivery_notices(read_bronze(spark, root, "pay_raw"))
    orders = read_accepted(spark, root, "orders")
    return apply_delivery_notices(orders, notices.withColumnRenamed("order_id", "id"), "id", delivered="DELIVERED")


def current_products(spark: SparkSession, root: str) -> DataFrame:
    """Accepted products with the newest stock and price that the warehouse reports for each."""
    updates = silver.stock_updates(read_bronze(spark, root, "wh_raw")).withColumnRenamed("product_id", "id")
    products = read_accepted(spark, root, "products")
    return apply_stock_updates(products, updates, "id", "updated_at", ["_event_id"])


#: silver table -> rules that a dead row is judged by again; the columns that it needs are those of the null rules.
REPLAYED: dict[str, tuple[str, ...]] = {
    "products": ("id", "sku", "name", "price"),
    "warehouse_events": ("sku", "name", "price"),
}


def retry_table(spark: SparkSession, root: str, entity: str) -> VersionedTable:
    """What replays have made of an entity's dead letters, one row for each message, by its digest."""
    return VersionedTable(spark, f"{root}/silver_retries/{entity}")


def _dead(spark: SparkSession, root: str, entity: str) -> DataFrame:
    """An entity's dead letters with the digest of their message and the retries they have had."""
    dead = read_routed(spark, root, entity, silver.DEAD_LETTER).withColumn("_digest", F.sha2("raw_data", 256))
    tried = retry_table(spark, root, entity).read("_digest string, _retry_count int, _route string").select(
        "_digest", F.col("_retry_count"), (F.col("_route") == silver.SILVER).alias("_recovered"))
    return dead.join(tried, "_digest", "left").withColumns({
        "_retry_count": F.coalesce("_retry_count", F.lit(0)), "_recovered": F.coalesce("_recovered", F.lit(False))})


def run_replay(spark: SparkSession, root: str, entity: str, now: Column, max_retries: int = 3) -> None:
    """Q6. Tries an entity's dead letters again and stores the outcome.

    A row that can be repaired comes back as silver from then on (see `read_accepted`). The others stay dead with one retry more; after
    `max_retries` they are retired. Rows whose key has been accepted meanwhile aren't tried. A row that the
    entity no longer has, as a newer version came, loses its entry.
    """
    needed, key = REPLAYED[entity], KEYS[entity][0]
    rules = [q.sku_format_variant(), *[q.null_rule(c) for c in needed], q.not_positive("price")]
    dead = _dead(spark, root, entity)
    accepted = read_routed(spark, root, entity, silver.SILVER).select(key)
    due = dead.filter(~F.col("_recovered")).withColumn("_quality_flag", F.lit(vocab.DIRTY)).drop("_recovered")
    again = q.replay_dead_letters(due, rules, list(needed), accepted, [key], now, max_retries).drop("_dlq_ingested_at")
    table = retry_table(spark, root, entity)
    kept = table.read(again.schema).join(dead.select("_digest").distinct(), "_digest", "left_semi").join(again.select("_digest"), "_digest", "left_anti")
    table.overwrite(again.unionByName(kept.select(*again.columns)))


def dead_letter_states(spark: SparkSession, root: str, entity: str, max_retries: int = 3) -> DataFrame:
    """An entity's dead letters with `_retry_count` and `_state`: recovered, retired, or waiting."""
    state = F.when(F.col("_recovered"), "recovered").when(F.col("_retry_count") >= max_retries, "retired").otherwise("waiting")
    return _dead(spark, root, entity).withColumn("_state", state).drop("_recovered")


def read_accepted(spark: SparkSession, root: str, entity: str) -> DataFrame:
    """Accepted rows of an entity, those included that a replay has repaired and whose key no accepted row has."""
    rows = read_routed(spark, root, entity, silver.SILVER)
    if entity not in REPLAYED:
        return rows
    key, table = KEYS[entity][0], retry_table(spark, root, entity)
    if table.manifest() is None:
        return rows
    still = read_routed(spark, root, entity, silver.DEAD_LETTER).select(F.sha2("raw_data", 256).alias("_digest")).distinct()
    repaired = table.read().filter(F.col("_route") == silver.SILVER).join(still, "_digest", "left_semi")
    first = repaired.withColumn("_place", F.row_number().over(Window.partitionBy(key).orderBy("_digest"))).filter("_place = 1")
    return rows.unionByName(first.join(rows.select(key), key, "left_anti").select(*rows.columns))


def build_gold(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The star schema from silver frames."""
    dims = {
        "dim_customers": gold.dim_customers(tables["customers"]),
        "dim_products": gold.dim_products(tables["products"]),
        "dim_payments": gold.dim_payments(tables["payments"]),
        "dim_shipping": gold.dim_shipping(tables["shipping"]),
        "dim_date": gold.dim_date(tables["orders"], "order_date"),
    }
    fact = gold.fact_sales(
        tables["order_items"], tables["orders"], dims["dim_customers"], dims["dim_products"],
        dims["dim_payments"], dims["dim_shipping"],
    )
    return {**dims, "fact_sales": fact}


def run_gold(spark: SparkSession, root: str, database: str = "gold") -> DataFrame:
    """Publish the star schema, of orders and products in their current state; returns the monthly revenue report over the published fact."""
    names = ("customers", "order_items", "payments", "shipping")
    tables = {n: read_accepted(spark, root, n) for n in names}
    tables |= {"orders": current_orders(spark, root), "products": current_products(spark, root)}
    ensure_database(spark, database)
    for name, df in build_gold(tables).items():
        parts = ["order_year", "order_month"] if name == "fact_sales" else []
        publish(df, database, name, f"{root}/gold/{name}", parts)
    return monthly_revenue(spark.table(f"{database}.fact_sales"))
