"""Versioned tables, and the incremental silver run on them."""

import glob
import json
import os
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from siltstone import schemas
from siltstone.plans import lakehouse
from siltstone.sources.tables import ensure_database, publish
from siltstone.sources.versions import ConcurrentWrite, VersionedTable
from tests.test_lakehouse import T0, envelope, message, order


def numbers(spark, n, parts=4):
    return spark.range(n).select("id", (F.col("id") % parts).cast("int").alias("part"), F.lit("x").alias("v"))


def test_a_write_that_dies_leaves_the_old_version(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    assert table.manifest() is None and table.read("id bigint").count() == 0
    with pytest.raises(ValueError):
        table.read()
    assert table.overwrite(numbers(spark, 10)) == 1
    broken = numbers(spark, 20).withColumn("v", F.when(F.col("id") == 19, F.raise_error(F.lit("lost"))).otherwise(F.col("v")))
    with pytest.raises(Exception, match="lost"):
        table.overwrite(broken)
    assert table.versions() == [1] and table.read().count() == 10
    assert table.overwrite(table.read().filter("id < 3")) == 2  # reads what it replaces
    assert sorted(r["id"] for r in table.read().collect()) == [0, 1, 2]
    assert table.read(version=1).count() == 10
    assert len(os.listdir(tmp_path / "t" / "data")) == 3
    assert table.vacuum(keep=1) == 2 and table.versions() == [2] and table.read().count() == 3


def test_one_of_two_writers_fails(spark, tmp_path, monkeypatch):
    table = VersionedTable(spark, str(tmp_path / "t"))
    table.overwrite(numbers(spark, 4))
    stale = table.manifest()
    table.overwrite(numbers(spark, 5))
    monkeypatch.setattr(VersionedTable, "manifest", lambda self, version=None: stale)
    with pytest.raises(ConcurrentWrite):
        table.overwrite(numbers(spark, 6))
    monkeypatch.undo()
    assert table.versions() == [1, 2] and table.read().count() == 5
    assert sorted(os.path.basename(f) for f in glob.glob(str(tmp_path / "t" / "_versions" / "*"))) == ["1.json", "2.json"]
    assert not [f for f in os.listdir(tmp_path / "t" / "_versions") if not f.endswith((".json", ".json.crc"))]


def test_parts_are_replaced_and_read_alone(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    table.replace(numbers(spark, 40).withColumn("kind", F.when(F.col("id") > 20, "a")), ["part"], ["kind"])
    before = {p["at"]["part"]: p for p in table.manifest()["parts"]}
    more = numbers(spark, 80).filter("part = 2").withColumn("kind", F.lit("a"))
    table.replace(more, ["part"], ["kind"], gone=lambda at: at["part"] in (2, 3))
    after = {p["at"]["part"]: p for p in table.manifest()["parts"]}
    assert set(after) == {0, 1, 2} and all(after[k] == before[k] for k in (0, 1)) and after[2]["rows"] == 20
    assert table.read().groupBy("part").count().orderBy("part").collect() == [(0, 10), (1, 10), (2, 20)]
    alone = table.read(only=lambda at: at["part"] == 1)
    assert alone.count() == 10 and all("part=1" in f for f in alone.inputFiles())
    assert table.read(only=lambda at: False).count() == 0
    with pytest.raises(ValueError, match="outside"):
        table.replace(numbers(spark, 9).withColumn("kind", F.lit("a")), ["part"], ["kind"], gone=lambda at: at["part"] == 1)
    with pytest.raises(ValueError, match="other columns"):
        table.replace(numbers(spark, 80).filter("part = 2"), ["part"], gone=lambda at: at["part"] == 2)
    assert len(table.versions()) == 2


def test_lost_files_are_found(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    table.replace(numbers(spark, 40).withColumn("part", F.when(F.col("part") > 0, F.col("part"))), ["part"])
    assert table.verify().collect() == []
    part = next(p for p in table.manifest()["parts"] if p["at"]["part"] is None)
    assert part["rows"] == 10
    os.remove(glob.glob(str(tmp_path / "t" / "data" / part["folder"] / "*.parquet"))[0])
    assert [tuple(r) for r in table.verify().collect()] == [(part["folder"], 10, 0)]


def test_a_published_table_is_never_gone(spark, tmp_path):
    ensure_database(spark, "versions_test")
    rows = numbers(spark, 8)
    for parts in ([], ["part"]):
        name = f"t{len(parts)}"
        publish(rows, "versions_test", name, str(tmp_path / name), parts)
        held = spark.table(f"versions_test.{name}")
        assert publish(rows.filter("id < 5"), "versions_test", name, str(tmp_path / name), parts).count() == 5
        assert held.count() in (5, 8)  # a frame resolved before still finds its files
        with pytest.raises(Exception, match="lost"):
            publish(rows.withColumn("v", F.raise_error(F.lit("lost"))), "versions_test", name, str(tmp_path / name), parts)
        assert spark.table(f"versions_test.{name}").count() == 5
        other = publish(rows.withColumn("more", F.lit(1)), "versions_test", name, str(tmp_path / name), parts)
        assert other.count() == 8 and "more" in other.columns


# --- the silver run -----------------------------------------------------------------------------


ODD = [None, "", " ", "N/A", " N/A ", "--", "null", "K1", " K1", "k_1", "K 1", "K1 ", "\tK1", 7, "K2"]


def odd_messages(day):
    """Every entity with odd keys; the second day repeats most of them, with new content."""
    out, at = [], f"2024-03-0{day}T00:00:0{day}"
    for k, key in enumerate(ODD):
        if day == 2 and k % 4 == 1:
            continue
        event, whole = f"e{day}-{k}", {None: None, "": "", "7": 7}.get(key, k if isinstance(key, str) else key)
        cdc = {"__op": "c", "__source_ts_ms": day}
        out += [
            ("erp.public.orders", order(whole, day, total_amount=f"{day}0.00", order_date=9223372036854775807 if k == 9 else 1709251200000)),
            ("erp.public.orders", order(str(key), day)),
            ("erp.public.customers", {"id": whole, "first_name": f"n{day}", "email": "a@b.co", "date_of_birth": -9223372036854775808, **cdc}),
            ("erp.public.order_items", {"id": whole, "order_id": 1, "product_id": 7, "quantity": day, "unit_price": "1", "total_price": "1", **cdc}),
            ("erp.public.products", {"id": whole, "name": "Lamp", "sku": key, "price": "5", **cdc}),
            ("warehouse.events", {"_event_id": event, "_event_type": "product.created", "_ingested_at": at, "_quality_flag": "CLEAN", "sku": key, "name": f"n{day}", "price": "3"}),
            ("payment.events", envelope("payment.created", event, at, {"payment_id": k, "order_id": 1, "payment_method": "paypal", "amount": 1.0, "status": "pending", "transaction_id": key})),
            ("payment.events", envelope("payment.status_updated", f"u{event}", at, {"transaction_id": key, "status_to": "completed"})),
            ("payment.events", envelope("shipping.created", f"s{event}", at, {"shipping_id": k, "order_id": 1, "tracking_number": key, "status": "pending"})),
            ("payment.events", envelope("shipping.status_updated", f"t{event}", at, {"tracking_number": key, "status_to": "delivered"})),
            ("payment.events", envelope("review.created", f"r{event}", at, {"review_id": whole, "product_id": 7, "rating": day})),
            ("payment.events", envelope("feedback.created", f"f{event}", at, {"feedback_id": whole, "customer_id": 1, "subject": f"s{day}"})),
        ]
    return [*out, ("erp.public.orders", f"{{broken {day}"), ("payment.events", f"{{broken {day}")]


def land(spark, root, messages, days, start):
    rows = [message(t, b, start + i) for i, (t, b) in enumerate(messages)]
    moved = [(k, v, t, p, o, at + timedelta(days=days)) for k, v, t, p, o, at in rows]
    spark.createDataFrame(moved, schemas.MESSAGE).write.mode("append").parquet(f"{root}/topics")
    lakehouse.run_bronze(spark, root, files=f"{root}/topics")


def content(spark, root):
    return {e: sorted(json.dumps(r.asDict(), default=str, sort_keys=True) for r in lakehouse.read_silver(spark, root, e).collect())
            for e in lakehouse.ENTITIES}


@pytest.fixture(scope="module")
def merged(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("merged"))
    land(spark, root, odd_messages(1), 0, 0)
    lakehouse.run_silver(spark, root, F.lit(T0), buckets=5)
    land(spark, root, odd_messages(2), 5, 10_000)
    lakehouse.run_silver(spark, root, F.lit(T0), since="2024-03-06", buckets=5)
    return root


def test_merged_runs_leave_what_a_full_run_does(spark, merged):
    found = content(spark, merged)
    again = lakehouse.run_silver(spark, merged, F.lit(T0), since="2024-03-06", buckets=5)
    assert set(map(tuple, again.values())) == {()}, "a repeated run changes nothing"
    lakehouse.run_silver(spark, merged, F.lit(T0), buckets=5)
    assert content(spark, merged) == found
    shipped = [json.loads(r) for r in found["shipping"]]
    keys = [r["tracking_number"] for r in shipped if r["_event_id"].startswith("se")]
    known = [k for k in keys if k is not None]
    assert len(known) == len(set(known)) and keys.count(None) > 10, "shipments with placeholders are each kept"
    orders = [json.loads(r) for r in found["orders"]]
    assert any("unreadable_order_date" in r["_reasons"] and r["_route"] == "silver" for r in orders)


def test_only_touched_buckets_are_read_and_written(spark, merged):
    history, table = lakehouse.history_table(spark, merged, "orders"), lakehouse.silver_table(spark, merged, "orders")
    before = {p["at"]["_bucket"]: p for p in table.manifest()["parts"]}
    land(spark, merged, [("erp.public.orders", order(424242, 9))], 9, 90_000)
    reads = []
    own = VersionedTable.read

    def seen(self, schema=None, only=None, version=None):
        found = own(self, schema, only, version)
        if self.path == history.path:
            reads.extend(found.inputFiles())
        return found

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(VersionedTable, "read", seen)
        touched = lakehouse.update_silver(spark, merged, "orders", since="2024-03-10", buckets=5)
    after = {p["at"]["_bucket"]: p for p in table.manifest()["parts"]}
    assert len(touched) == 1 and {b for b in after if after[b] != before.get(b)} == set(touched)
    assert reads and all(f"_bucket={touched[0]}/" in f for f in reads)
    assert lakehouse.read_silver(spark, merged, "orders").filter("id = 424242").count() == 1


def test_a_run_that_died_between_history_and_entity_is_made_good(spark, merged, monkeypatch):
    land(spark, merged, [("erp.public.orders", order(515151, 9))], 12, 95_000)
    own = VersionedTable.replace

    def dies(self, *a, **k):
        if "/silver/" in self.path:
            raise RuntimeError("lost")
        return own(self, *a, **k)

    monkeypatch.setattr(VersionedTable, "replace", dies)
    with pytest.raises(RuntimeError):
        lakehouse.update_silver(spark, merged, "orders", since="2024-03-13", buckets=5)
    monkeypatch.undo()
    assert lakehouse.read_silver(spark, merged, "orders").filter("id = 515151").count() == 0
    assert len(lakehouse.update_silver(spark, merged, "orders", since="2024-03-13", buckets=5)) == 1
    assert lakehouse.read_silver(spark, merged, "orders").filter("id = 515151").count() == 1
    assert len(lakehouse.update_silver(spark, merged, "orders", buckets=7)) > 1, "another number of buckets is a full run"
