"""Readers, tables, guarded SQL."""

import json

import pytest
from pyspark.sql import functions as F

from siltstone import schemas
from siltstone.plans import guarded
from siltstone.session import scratch_folder
from siltstone.sources import files, snapshots, tables
from siltstone.sources.bronze import route_topic, to_bronze


def test_read_or_empty(spark, tmp_path):
    assert files.read_or_empty(spark, str(tmp_path / "nothing"), "id int, v string").dtypes == [("id", "int"), ("v", "string")]
    tables.overwrite_table(spark.range(3).select(F.col("id").cast("int"), F.lit("x").alias("v")), str(tmp_path / "t"))
    tables.overwrite_table(spark.range(2).select(F.col("id").cast("int"), F.lit("y").alias("v")), str(tmp_path / "t"))
    assert files.read_or_empty(spark, str(tmp_path / "t"), "id int, v string").count() == 2
    with pytest.raises(Exception, match="nosuchscheme"):
        files.read_or_empty(spark, "nosuchscheme://x/y", "id int")


CSV = """id,code,max_uses,valid_from
1,MEGA857,100,2025-07-25
2,"two
lines",50,2022-03-19
3,SUPER489,true,2023-02-11
4,LONG,5,2023-02-11,extra
5,SHORT
6,,,
"""


def test_csv_keeps_rows_that_do_not_fit(spark, tmp_path):
    (tmp_path / "coupons.csv").write_text(CSV)
    df = files.read_csv(spark, str(tmp_path / "coupons.csv"), "id int, code string, max_uses int, valid_from string")
    clean, corrupt = files.split_corrupt(df)
    assert sorted(r[0] for r in clean.select("id").collect()) == [1, 2, 6]
    assert sorted(r[0] for r in corrupt.select("id").collect()) == [3, 4, 5]
    assert clean.filter("id = 2").first()["code"] == "two\nlines"


def test_corrupt_rows_do_not_depend_on_the_columns_used(spark, tmp_path):
    (tmp_path / "coupons.csv").write_text(CSV)
    df = files.read_csv(spark, str(tmp_path / "coupons.csv"), "id int, code string, max_uses int, valid_from string")
    assert files.split_corrupt(df)[1].count() == 3
    assert files.split_corrupt(df)[0].select("id").count() == 3


def test_json_array_of_mixed_types(spark, tmp_path):
    data = [{"id": 1, "max_uses": 5}, {"id": 2, "max_uses": "N/A"}, {"id": 3, "max_uses": None}, {"id": 4, "max_uses": True}]
    (tmp_path / "c.json").write_text(json.dumps(data, indent=1))
    df = files.read_json_array(spark, str(tmp_path / "c.json"))
    assert dict(df.dtypes)["max_uses"] == "string"
    assert [r[0] for r in df.orderBy("id").select("max_uses").collect()] == ["5", "N/A", None, "true"]


def test_publish_registers_an_external_table(spark, tmp_path):
    tables.ensure_database(spark, "shop")
    df = spark.range(24).select("id", (F.col("id") % 2 + 2023).cast("int").alias("y"), (F.col("id") % 12).cast("int").alias("m"))
    for _ in range(2):
        out = tables.publish(df, "shop", "sales", str(tmp_path / "sales"), ["y", "m"])
    assert out.count() == 24
    assert [tuple(r) for r in tables.list_tables(spark, "shop").collect()] == [("sales", "EXTERNAL")]
    plan = out.filter("y = 2023")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(y" in plan
    shown = guarded.describe_schema(spark, "shop").collect()
    assert ("sales", "id", "bigint") in {tuple(r)[:3] for r in shown}


def test_snapshots(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id int, v string")
    cdc = spark.createDataFrame([(1, "a1", "u", 5), (1, "a2", "u", None), (2, None, "d", 6), (4, "d", "c", 1)],
                                "id int, v string, __op string, __source_ts_ms int")
    out = snapshots.merge_history(old, cdc, ["id"])
    assert sorted((r["id"], r["v"], r["_load_type"]) for r in out.collect()) == [(1, "a1", "cdc"), (3, "c", "historical"), (4, "d", "cdc")]
    tagged = snapshots.tag_snapshot(old, "erp", "t", F.lit("now")).first()
    assert (tagged["_load_type"], tagged["_source_system"], tagged["_table_name"], tagged["_loaded_at"]) == ("historical", "erp", "t", "now")
    assert [r["row_count"] for r in snapshots.snapshot_manifest({"t": old}, F.lit("now")).collect()] == [3]


def test_topics(spark):
    names = ["erp.public.orders", "warehouse.events", "warehouse.events.dlq", "payment.events", "payment.events.dlq", "xpayment.events", "warehouseXevents"]
    df = spark.createDataFrame([(n,) for n in names], "topic string")
    got = [r[0] for r in df.select(route_topic(F.col("topic"))).collect()]
    assert got == ["erp_raw", "wh_raw", "wh_dlq", "pay_raw", "pay_dlq", None, None]


def test_to_bronze_matches_its_schema(spark):
    messages = spark.createDataFrame([], schemas.MESSAGE)
    want = spark.createDataFrame([], schemas.BRONZE)
    assert to_bronze(messages).dtypes == want.dtypes


def test_scratch_folder_uses_the_shared_folder(spark):
    assert scratch_folder(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir") + "/x-")


def test_spread_scan(spark, tmp_path):
    tables.overwrite_table(spark.range(10).coalesce(1), str(tmp_path / "one"))
    one = spark.read.parquet(str(tmp_path / "one"))
    assert files.spread_scan(one, spark.sparkContext.defaultParallelism).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    wide = spark.range(100, numPartitions=40)
    assert files.spread_scan(wide, 40) is wide


# --- guarded SQL --------------------------------------------------------------------------------


@pytest.fixture
def big(spark):
    spark.range(1000).withColumn("updated_at", F.lit("drop")).createOrReplaceTempView("big")
    return "big"


@pytest.mark.parametrize("query, rows", [
    ("SELECT updated_at FROM big", 100), ("SELECT * FROM big LIMIT 250;", 250), ("WITH b AS (SELECT * FROM big) SELECT id FROM b", 100),
    ("SELECT id FROM (SELECT id FROM big LIMIT 500) x", 100), ("SELECT 'DROP TABLE x; limit 5' AS t FROM big -- delete", 100),
    ("(SELECT id FROM big)", 100), ("SELECT count(*) FROM big", 1),
])
def test_reads_are_allowed_and_capped(spark, big, query, rows):
    assert guarded.guarded_sql(spark, query).count() == rows


@pytest.mark.parametrize("query", [
    "DROP TABLE x", "INSERT INTO big VALUES (1)", "SELECT 1; DROP TABLE big", "TRUNCATE TABLE big", "update big set id = 1",
    "WITH a AS (SELECT 1) INSERT INTO big SELECT * FROM a", "SHOW TABLES", "",
])
def test_writes_are_refused(spark, query):
    with pytest.raises(guarded.ForbiddenQuery):
        guarded.guarded_sql(spark, query)
