"""State machines on streams over restarts, packed landing files, hierarchies, guarded statements."""

import glob
import os
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from siltstone import schemas
from siltstone.operators.dedup import dedup_events
from siltstone.operators.hierarchy import hierarchy, hierarchy_report
from siltstone.plans import gold, guarded, lakehouse
from siltstone.sources import compaction
from siltstone.sources.bronze import read_topics, to_bronze
from siltstone.sources.versions import VersionedTable
from siltstone.streaming import flows, state

T0 = datetime(2024, 3, 1)


def at(minutes):
    return T0 + timedelta(minutes=minutes)


# --- streams ------------------------------------------------------------------------------------


def drained(spark, tmp_path, schema, build, rows):
    """Rows added as a file, the stream run until it has them all and stopped: state comes from the checkpoint each time."""
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = build(spark.readStream.schema(schema).parquet(str(tmp_path / "in")))
    flows.drain(stream, str(tmp_path / "out"), str(tmp_path / "ck"))
    return spark.read.parquet(str(tmp_path / "out"))


def test_status_history_goes_on_after_a_restart(spark, tmp_path):
    schema = "parcel string, at timestamp, event bigint, status_to string"
    build = lambda s: state.status_stream(s, "parcel", "at", "event")
    drained(spark, tmp_path, schema, build, [("a", at(1), 1, "pending"), ("a", at(2), 2, "picked_up"), ("b", at(1), 3, "pending"), (None, at(1), 4, "pending")])
    drained(spark, tmp_path, schema, build, [("a", at(3), 5, "delivered"), ("a", at(4), 6, None), ("a", at(1), 0, "returned"), ("a", None, 9, "returned")])
    out = drained(spark, tmp_path, schema, build, [("a", at(5), 7, "delivered"), ("b", at(0), 8, "picked_up"), ("b", at(6), 10, "picked_up")])
    rows = [r.asDict() for r in out.collect()]
    bad = sorted((r["parcel"], r["event"], r["kind"], r["status_from"], r["status_to"]) for r in rows if r["kind"] != "state")
    assert bad == [("a", 0, "out_of_order", None, "returned"), ("a", 5, "illegal", "picked_up", "delivered"), ("b", 8, "out_of_order", None, "picked_up")]
    last = {}
    for r in sorted((r for r in rows if r["kind"] == "state"), key=lambda r: r["changes"]):
        last[r["parcel"]] = (r["status_to"], r["changes"], r["shipped_at"], r["delivered_at"])
    assert last == {"a": ("delivered", 5, at(2), at(3)), "b": ("picked_up", 3, at(0), None), None: ("pending", 1, None, None)}


@pytest.mark.parametrize("salts", [1, 3])
def test_payments_are_told_from_each_other_over_restarts(spark, tmp_path, salts):
    schema = "kind string, id bigint, order_id bigint, at timestamp"

    def build(stream):
        paid = stream.filter("kind = 'p'").select(F.col("id").alias("payment"), "order_id", F.col("at").alias("paid_at"))
        made = stream.filter("kind = 'o'").select("order_id", F.col("at").alias("ordered_at"))
        return state.payment_desk_stream(paid, made, "order_id", "payment", "paid_at", "ordered_at", minutes=10, remember=120, salts=salts)

    drained(spark, tmp_path, schema, build, [("o", None, 1, at(0)), ("p", 11, 1, at(5)), ("p", 12, 2, at(5)), ("p", 13, 3, at(6)), ("p", None, 1, at(5)), ("p", 19, None, at(5))])
    drained(spark, tmp_path, schema, build, [("o", None, 2, at(12)), ("p", 14, 1, at(11)), ("p", 15, 4, at(14))])
    out = drained(spark, tmp_path, schema, build, [("o", None, 9, at(60))])
    assert {r["payment"]: (r["order_id"], r["result"]) for r in out.collect()} == {
        11: (1, "joined"), 12: (2, "joined"), 14: (1, "late"), 13: (3, "no_order"), 15: (4, "no_order")}
    drained(spark, tmp_path, schema, build, [("p", 16, 1, at(70)), ("o", None, 9, at(400))])
    out = drained(spark, tmp_path, schema, build, [("p", 17, 1, at(420)), ("o", None, 9, at(900))])
    found = {r["payment"]: r["result"] for r in out.collect()}
    assert found[16] == "late" and found[17] == "no_order", "an order is remembered for a time"
    assert out.count() == len(found)


def test_payments_due_at_the_watermark_have_no_order(spark, tmp_path):
    schema, fine = "kind string, id bigint, order_id bigint, at timestamp", timedelta(microseconds=1)

    def build(stream):
        paid = stream.filter("kind = 'p'").select(F.col("id").alias("payment"), "order_id", F.col("at").alias("paid_at"))
        made = stream.filter("kind = 'o'").select("order_id", F.col("at").alias("ordered_at"))
        return state.payment_desk_stream(paid, made, "order_id", "payment", "paid_at", "ordered_at", minutes=10, buckets=2)

    many = [("p", k, k, at(5)) for k in range(10, 40)]
    out = drained(spark, tmp_path, schema, build, [("p", 1, 1, at(5)), ("p", 2, 2, at(5) - fine), ("p", 3, 3, at(5) + fine), ("o", None, 4, at(25)), *many])
    found = {r["payment"]: (r["order_id"], r["result"]) for r in out.collect()}
    assert found == {k: (k, "no_order") for k in (1, 2, *range(10, 40))}


def test_the_desk_calls_its_store_once_for_a_bucket():
    calls = []

    class Store:
        held = None

        def get(self):
            calls.append("get")
            return self.held

        def update(self, value):
            calls.append("update")
            self.held = value

        def clear(self):
            calls.append("clear")
            self.held = None

    class Handle:
        def __init__(self):
            self.store = Store()

        def getValueState(self, name, schema):
            return self.store

        def registerTimer(self, at):
            calls.append("timer")

    class Times:
        def __init__(self, now):
            self.now = now

        def getCurrentWatermarkInMs(self):
            return self.now

    bigint = StructType.fromDDL("x bigint")["x"]
    desk = state.PaymentDesk(["order_id", "payment", "paid_at", "ordered_at", "result"], bigint, bigint, 10_000_000, 60_000_000)
    desk.init(Handle())
    rows = [{"order": k, "payment": None if k % 2 else 1000 + k, "at_us": k * 1000} for k in range(500)]
    assert list(desk.handleInputRows((0, 0), iter(rows), Times(0))) == [] and len(calls) == 3
    late = [{"order": k, "payment": k, "at_us": k * 1000} for k in range(1, 500, 2)]
    assert [r["result"] for r in desk.handleInputRows((0, 0), iter(late), Times(0))] == ["joined"] * 250 and len(calls) == 4
    told = list(desk.handleExpiredTimer((0, 0), Times(20_000), None))
    assert len(told) == 250 and {r["result"] for r in told} == {"no_order"} and len(calls) == 7
    assert list(desk.handleExpiredTimer((0, 0), Times(90_000), None)) == [] and calls[-1] == "clear" and desk.state.held is None


# --- packed landing files -----------------------------------------------------------------------


def test_bins_hold_one_folder_and_no_more_than_the_target():
    sizes = [(f"f{k % 3}", f"n{k}", (k * 37) % 90 + 1) for k in range(100)] + [("f0", "large", 500)]
    bins = compaction.pack(sizes, 100)
    held, folders = Counter(), {}
    for folder, name, size in sizes:
        held[bins[name]] += size
        folders.setdefault(bins[name], set()).add(folder)
    assert all(len(f) == 1 for f in folders.values())
    assert all(n <= 100 for b, n in held.items() if b != bins["large"]) and held[bins["large"]] == 500
    assert len(held) <= 2 * sum(s for _, _, s in sizes) / 100 + 3


def land(spark, root, first, n, files=6, topic="erp.public.orders"):
    rows = [(b"k", f"{i}".encode(), topic, i % 2, i // 2, at(60 * 20 * (i % 3))) for i in range(first, first + n)]
    spark.createDataFrame(rows, schemas.MESSAGE).repartition(files).write.mode("append").parquet(f"{root}/topics")
    return lakehouse.run_bronze(spark, root, files=f"{root}/topics")


def contents(spark, root, since=None):
    return sorted(int(r["raw_data"]) for r in lakehouse.read_bronze(spark, root, "erp_raw", since).collect())


def test_landing_files_are_packed_once_while_landing_goes_on(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    land(spark, root, 0, 300)
    assert lakehouse.compact_bronze(spark, root) == {"erp_raw": 1, "wh_raw": None, "wh_dlq": None, "pay_raw": None, "pay_dlq": None}
    assert contents(spark, root) == list(range(300))
    small = glob.glob(f"{root}/bronze/erp_raw/**/part-*.parquet", recursive=True)
    table = VersionedTable(spark, f"{root}/bronze_packed/erp_raw")
    parts = table.manifest()["parts"]
    assert len(small) >= 12 and [p["files"] for p in parts] == [1] * len(parts) and len(parts) == 2
    assert table.verify().collect() == []

    land(spark, root, 300, 200)
    assert contents(spark, root) == list(range(500)), "packed records and landing files behind them"
    own = VersionedTable.replace
    monkeypatch.setattr(VersionedTable, "replace", lambda self, *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        lakehouse.compact_bronze(spark, root)
    monkeypatch.setattr(VersionedTable, "replace", own)
    assert contents(spark, root) == list(range(500))
    lakehouse.compact_bronze(spark, root)
    assert contents(spark, root) == list(range(500))
    assert [p["rows"] for p in table.manifest()["parts"]] == [334, 166], "small runs are packed again with what is new"
    assert lakehouse.compact_bronze(spark, root)["erp_raw"] is None
    assert contents(spark, root, since="2024-03-02") == [i for i in range(500) if i % 3 == 2]

    land(spark, root, 500, 100)
    compaction.compact(spark, f"{root}/bronze/erp_raw", f"{root}/bronze_packed/erp_raw", target=2000)
    held = table.manifest()["parts"]
    assert contents(spark, root) == list(range(600)) and len(held) == 4, "runs over the target stay"
    assert all(p["bytes"] < 60_000 for p in held)


def test_packing_needs_offsets(spark, tmp_path):
    rows = [("x", "k", None, 5, None, T0), ("y", "k", 0, None, None, T0)]
    for row in rows:
        path = str(tmp_path / row[0])
        df = spark.createDataFrame([row], "raw_data string, kafka_key string, _kafka_partition int, _kafka_offset bigint, _kafka_timestamp timestamp, _bronze_ingested_at timestamp")
        df.withColumns({"_source_topic": F.lit("t"), "ingest_date": F.lit(T0).cast("date")}).write.partitionBy("_source_topic", "ingest_date").parquet(path)
        with pytest.raises(ValueError, match="offset"):
            compaction.compact(spark, path, f"{path}-packed")
    assert compaction.compact(spark, str(tmp_path / "nothing"), str(tmp_path / "packed")) is None
    assert not os.path.exists(tmp_path / "x-packed" / "_versions")


def test_topics_are_packed_apart(spark, tmp_path):
    root = str(tmp_path)
    land(spark, root, 0, 40, 2, "erp.public.orders")
    land(spark, root, 100, 40, 2, "erp.public.customers")
    lakehouse.compact_bronze(spark, root)
    packed = lakehouse.read_bronze(spark, root, "erp_raw")
    assert {r["_source_topic"]: r["count"] for r in packed.groupBy("_source_topic").count().collect()} == {"erp.public.orders": 40, "erp.public.customers": 40}
    assert packed.columns == to_bronze(read_topics(spark, ".*", files=f"{root}/topics")).columns or set(packed.columns) == set(schemas.BRONZE.replace(",", "").split()[::2])


# --- hierarchies --------------------------------------------------------------------------------


def expected(rows):
    parents = {}
    for i, p in rows:
        if i is not None:
            parents[i] = p if i not in parents or parents[i] is None else parents[i] if p is None else min(p, parents[i])
    out = []
    for i, p in rows:
        if i is None:
            out.append((i, p, None, None, "no_id"))
            continue
        chain, here = [i], i
        while parents[here] is not None and parents[here] in parents and parents[here] not in chain:
            here = parents[here]
            chain.append(here)
        above = parents[here]
        if above is None or above not in parents:
            out.append((i, p, len(chain) - 1, here, "ok" if above is None else "orphaned"))
        else:
            out.append((i, p, None, None, "cycle" if above == i else "into_cycle"))
    return out


@pytest.mark.parametrize("rows", [
    [(1, None), (2, 1), (3, 2), (4, 99), (5, 4), (6, 7), (7, 8), (8, 6), (9, 6), (10, 9), (11, 11), (12, 11), (None, 1), (None, None)],
    [(k, k - 1 if k else None) for k in range(70)],
    [(k, (k + 1) % 33) for k in range(33)] + [(100 + k, 99 + k if k else 5) for k in range(50)],
    [(1, None), (1, 2), (2, None), (3, 1), (3, 1)],
    [(k, None) for k in range(5)], [],
], ids=["all kinds", "chain", "cycle with a tail", "an id twice", "roots", "nothing"])
def test_hierarchy(spark, no_broadcast, rows):
    df = spark.createDataFrame(rows, "id bigint, parent bigint")
    key = lambda r: tuple((v is not None, v if v is not None else 0) for v in r[:4])
    found = hierarchy(df, "id", "parent")
    assert sorted(map(tuple, found.collect()), key=key) == sorted(expected(rows), key=key)
    counts = {r["state"]: r["rows"] for r in hierarchy_report(found).collect()}
    assert counts == dict(Counter(r[4] for r in expected(rows)))


# --- statements, events, days -------------------------------------------------------------------


@pytest.fixture
def tables(spark, tmp_path):
    spark.range(300).withColumn("v", F.lit("x")).createOrReplaceTempView("guarded_a")
    spark.range(3).createOrReplaceTempView("guarded_b")
    spark.sql("CREATE DATABASE IF NOT EXISTS guarded_db")
    spark.sql(f"CREATE TABLE IF NOT EXISTS guarded_db.t (id BIGINT) USING parquet LOCATION '{tmp_path / 't'}'")
    yield
    spark.sql("DROP TABLE guarded_db.t")
    spark.catalog.dropTempView("guarded_a")
    spark.catalog.dropTempView("guarded_b")


@pytest.mark.parametrize("query", [
    "SELECT * FROM guarded_a", "SELECT count(*) FROM guarded_a WHERE id IN (SELECT id FROM guarded_b)", "SELECT 1 + 1",
    "WITH x AS (SELECT id FROM guarded_b) SELECT x.id, (SELECT max(id) FROM guarded_a) FROM x JOIN x y ON x.id = y.id",
    "SELECT * FROM VALUES (1), (2)", "SELECT id FROM guarded_db.t", "SELECT explode(array(1, 2))", "SELECT 'reflect(' AS v FROM guarded_b"])
def test_plain_reads_pass(spark, tables, query):
    assert guarded.guarded_sql(spark, query, 100).count() <= 100


@pytest.mark.parametrize("query", [
    "SELECT reflect('java.lang.System', 'getProperty', 'user.home')", "SELECT `reflect`('java.lang.System', 'getenv', 'PATH')",
    "SELECT java_method('java.lang.Math', 'abs', id) FROM guarded_b", "SELECT try_reflect('java.lang.Math', 'abs', 1)",
    "SELECT id FROM guarded_b WHERE reflect('java.lang.Math', 'abs', 1) = '1'",
    "SELECT * FROM text.`/etc/hostname`", "SELECT * FROM guarded_b WHERE EXISTS (SELECT * FROM text.`/etc/hostname`)",
    "WITH x AS (SELECT * FROM csv.`/etc/hostname`) SELECT 1 FROM guarded_b, x", "SELECT (SELECT max(value) FROM text.`/etc/hostname`)"])
def test_code_and_files_are_refused(spark, tables, query):
    with pytest.raises(guarded.ForbiddenQuery):
        guarded.guarded_sql(spark, query)


def test_functions_in_python_are_refused(spark, tables):
    spark.udf.register("guarded_f", lambda v: v, LongType())
    with pytest.raises(guarded.ForbiddenQuery):
        guarded.guarded_sql(spark, "SELECT guarded_f(id) FROM guarded_b")


def test_only_given_tables(spark, tables):
    assert guarded.guarded_sql(spark, "SELECT * FROM guarded_b", tables=["guarded_b"]).count() == 3
    assert guarded.guarded_sql(spark, "SELECT * FROM guarded_db.t", tables=["guarded_db.t"]).count() == 0
    for query in ("SELECT * FROM guarded_a", "SELECT * FROM guarded_b WHERE id IN (SELECT id FROM guarded_a)", "SELECT * FROM guarded_db.t"):
        with pytest.raises(guarded.ForbiddenQuery, match="allowed"):
            guarded.guarded_sql(spark, query, tables=["guarded_b"])


def test_events_without_an_id_are_no_redeliveries(spark):
    rows = [(None, "T1", at(0)), (None, "T2", at(1)), ("", "T3", at(2)), ("", "T4", at(3)), ("e1", "T5", at(4)), ("e1", "T6", at(5)), (None, "T1", at(6)), (None, None, at(0))]
    df = spark.createDataFrame(rows, "_event_id string, transaction_id string, _ingested_at timestamp")
    assert sorted((r["transaction_id"], r["_ingested_at"]) for r in dedup_events(df).collect()) == [
        ("T1", at(0)), ("T2", at(1)), ("T3", at(2)), ("T4", at(3)), ("T5", at(4))]


def test_every_dated_row_has_its_day(spark):
    df = spark.createDataFrame([("2024-01-30",), ("2024-02-02",), ("9999-12-31",), ("0001-01-01",), (None,)], "d string").withColumn("d", F.to_date("d"))
    found = sorted(str(r["date"]) for r in gold.dim_date(df, "d").collect())
    assert found == ["0001-01-01", "2024-01-30", "2024-01-31", "2024-02-01", "2024-02-02", "9999-12-31"]
    assert gold.dim_date(df.filter("d is null"), "d").count() == 0
