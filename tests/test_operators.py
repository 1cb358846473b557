"""Golden cases and invariants of the DataFrame operators."""

from datetime import datetime, timedelta

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from siltstone import vocab
from siltstone.operators import dedup, missing, quality, references, reports, skew, status
from siltstone.operators.quantiles import approx_quantiles, drop_outliers, exact_quantiles, iqr_bounds

T0 = datetime(2024, 1, 1)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


# --- duplicates ---------------------------------------------------------------------------------


def test_dedup_events(spark):
    """Every event delivered three times, the last time under another transaction."""
    data = [(f"e{i}", f"t{i % 4}" if i % 5 else "", T0 + timedelta(seconds=7 * i % 11)) for i in range(12)]
    copies = [(e, "moved", at + timedelta(seconds=60)) for e, _, at in data]
    df = spark.createDataFrame(data * 2 + copies, "_event_id string, transaction_id string, _ingested_at timestamp")
    first = {}
    for e, t, at in data:
        if t:
            first[t] = min(first.get(t, (at, e)), (at, e))
    want = sorted(e for _, e in first.values())
    assert [r[0] for r in dedup.dedup_events(df).orderBy("_event_id").collect()] == want
    vouched = df.filter("transaction_id != 'moved'")
    assert [r[0] for r in dedup.dedup_events(vouched, redelivered_as_is=True).orderBy("_event_id").collect()] == want


def test_latest_per_key_orders_missing_times_last(spark):
    df = spark.createDataFrame([(1, None, "a"), (1, 5, "b"), (1, 5, "c"), (2, None, "d")], "k int, ts int, v string")
    assert rows(dedup.latest_per_key(df, ["k"], "ts", ["v"]).select("k", "v")) == [(1, "c"), (2, "d")]


def test_duplicate_count(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "x")], "a int, b string")
    assert rows(dedup.duplicate_count(df)) == [(3, 2, 1)]
    assert rows(dedup.duplicate_count(df.filter("a > 9"))) == [(0, 0, 0)]


def brute_near(data, tolerance=0.01):
    found = []
    for i, k, s, a in data:
        near = [j for j, k2, s2, a2 in data if k2 == k and s2.strip().lower() == s.strip().lower() and abs(round(a2 - a, 2)) <= tolerance]
        if min(near) < i:
            found.append((i, min(near), len(near)))
    return sorted(found)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(1, 2), st.sampled_from(["A", "a ", "B"]), st.integers(100, 106)), max_size=12))
def test_near_duplicates_against_brute_force(spark, given_rows):
    data = [(i, k, s, c / 100) for i, (k, s, c) in enumerate(given_rows)]
    df = spark.createDataFrame(data, "id int, k int, s string, amount double")
    assert rows(dedup.near_duplicates(df, "id", ["k"], ["s"], "amount").select("id", "twin_id", "near_rows")) == brute_near(data)


@pytest.fixture(scope="module")
def hot(spark):
    """A third of the rows on one key, some without a key."""
    return spark.range(3000).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 100).alias("k"),
        (F.col("id") * 7919 % 3001).alias("at"),
    )


def test_flag_repeats_on_a_hot_key(hot, no_broadcast):
    out = dedup.flag_repeats(hot, ["k"], ["at", "id"])
    firsts = out.filter("NOT is_repeat")
    assert out.count() == 3000 and firsts.count() == hot.select("k").distinct().count()
    best = hot.groupBy("k").agg(F.min(F.struct("at", "id")).alias("m")).select("k", "m.id")
    assert {tuple(r) for r in firsts.select("k", "id").collect()} == {tuple(r) for r in best.collect()}


def test_one_of_equal_rows_is_the_first(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (None, "a"), (None, "a"), (2, None)], "k int, v string")
    out = dedup.flag_repeats(df, ["k"], ["v"])
    assert out.filter("NOT is_repeat").count() == 3 and out.filter("is_repeat").count() == 3
    assert out.filter("is_repeat AND v = 'b'").count() == 1


def test_near_duplicates_of_dressed_amounts_and_missing_keys(spark):
    df = spark.createDataFrame([
        (1, 7, "a", "$10.00"), (2, 7, "A ", "10.009USD"), (3, 7, "a", "10.02"), (4, None, "a", "10.00"), (5, None, "a", "10.00"),
        (6, 7, "a", "n/a"), (7, 7, "a", "1e30"), (8, 7, "a", "1e30"), (9, 8, None, "1,234.5"), (10, 8, None, "1234.50"),
    ], "id int, k int, s string, amount string")
    out = dedup.near_duplicates(df, "id", ["k"], ["s"], "amount")
    assert rows(out.select("id", "twin_id", "near_rows")) == [(2, 1, 2), (8, 7, 2), (10, 9, 2)]
    wide = dedup.near_duplicates(df.filter("id < 4"), "id", ["k"], ["s"], "amount", "0.015")
    assert rows(wide.select("id", "twin_id", "near_rows")) == [(2, 1, 3), (3, 2, 2)]
    far = spark.createDataFrame([(1, 7, 5.005), (2, 7, 5.0249), (3, 7, 5.0151)], "id int, k int, amount double")
    assert rows(dedup.near_duplicates(far, "id", ["k"], [], "amount").select("id", "twin_id")) == [(3, 2)]


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_skew_join_across_key_types(hot, no_broadcast, how):
    narrow = hot.sparkSession.createDataFrame([(7, "x"), (8, "y")], "k int, v string")
    assert hot.schema["k"].dataType.simpleString() == "bigint"
    got = skew.skew_join(hot, narrow, ["k"], how)
    met, every = hot.filter("k IN (7, 8)").count(), hot.count()
    assert got.count() == {"inner": met, "left": every, "left_semi": met, "left_anti": every - met}[how]


def test_previous_value_across_chunks(spark, no_broadcast):
    df = spark.range(500).select(
        F.when(F.col("id") % 5 != 0, F.col("id") % 4).alias("k"), F.when(F.col("id") % 9 != 0, (F.col("id") % 7).cast("string")).alias("s"), F.col("id"),
        F.timestamp_seconds(F.col("id") * 997 % 90000).alias("at"))
    from pyspark.sql import Window

    want = df.withColumn("_previous", F.lag("s").over(Window.partitionBy("k").orderBy("at", "id")))
    assert rows(skew.previous_value(df, ["k"], "s", "at", "id").select("id", F.coalesce("_previous", F.lit("-")))) == \
        rows(want.select("id", F.coalesce("_previous", F.lit("-"))))


# --- quantiles ----------------------------------------------------------------------------------


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.integers(-10**9, 10**9), min_size=1, max_size=30))
def test_exact_quantiles(spark, cents):
    df = spark.createDataFrame([(c / 100,) for c in cents], "v double")
    got = exact_quantiles(df, "v", [0.0, 0.25, 0.5, 0.9, 1.0]).first()[0]
    assert np.allclose(got, np.quantile([c / 100 for c in cents], [0.0, 0.25, 0.5, 0.9, 1.0]))


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.floats(allow_nan=False, allow_infinity=False), min_size=1, max_size=40))
def test_quantiles_of_any_doubles(spark, values):
    """Without interpolation the result is one of the values, bit for bit."""
    df = spark.createDataFrame([(v,) for v in values], "v double")
    n = len(values) - 1
    ranks = sorted({0, n // 3, n // 2, n})
    got = exact_quantiles(df, "v", [r / n if n else 0.0 for r in ranks]).first()[0]
    position = [(r / n if n else 0.0) * n for r in ranks]
    for g, p in zip(got, position):
        if p == int(p):
            assert g == sorted(values)[int(p)]


def test_quantiles_of_other_types(spark):
    small = spark.createDataFrame([(0.001,), (0.002,), (0.004,)], "v double")
    assert exact_quantiles(small, "v", [0.5]).first()[0] == [0.002]
    big = spark.createDataFrame([(1_700_000_000_000_000 + i,) for i in range(3)], "v bigint")
    assert exact_quantiles(big, "v", [0.5]).first()[0] == [1_700_000_000_000_001.0]
    wide = spark.sql("SELECT CAST(v AS DECIMAL(38,6)) AS v FROM VALUES (12345678901234567890123.5BD), (-1BD), (3BD) t(v)")
    assert exact_quantiles(wide, "v", [0.0, 0.5, 1.0]).first()[0] == [-1.0, 3.0, 12345678901234567890123.5]
    odd = spark.createDataFrame([(float("nan"),), (1.0,), (float("inf"),), (-float("inf"),), (None,), (-0.0,)], "v double")
    found = exact_quantiles(odd, "v", [0.0, 0.25, 0.5, 0.75, 1.0]).first()[0]
    assert found[:4] == [-float("inf"), 0.0, 1.0, float("inf")] and np.isnan(found[4])


def test_group_quantiles_with_null_group(spark, no_broadcast):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("a", None), (None, 5), (None, 9)], "g string, v int")
    assert {r[0]: r[1] for r in exact_quantiles(df, "v", [0.5], ["g"]).collect()} == {"a": [1.5], None: [7.0]}


def test_quantile_sketch_is_close(spark):
    got = approx_quantiles(spark.range(10001).withColumnRenamed("id", "v"), "v", [0.25, 0.75]).first()[0]
    assert np.allclose(got, [2500, 7500], atol=20)


def test_outliers_keep_missing_values(spark):
    df = spark.createDataFrame([(float(v),) for v in range(20)] + [(1000.0,), (None,)], "v double")
    kept = [r[0] for r in drop_outliers(df, "v").collect()]
    assert 1000.0 not in kept and None in kept and len(kept) == 21
    assert iqr_bounds(df.filter("v < 5"), "v").first()["iqr"] == 2.0


def test_imputation(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("a", 3.0), ("b", 9.0), ("b", None)], "g string, v double")
    assert sorted(r[1] for r in missing.impute_median(df, ["v"]).collect()) == [1.0, 3.0, 3.0, 3.0, 9.0]
    assert rows(missing.impute_median(df, ["v"], by=["g"]))[:3] == [("a", 1.0), ("a", 2.0), ("a", 3.0)]
    lone = spark.createDataFrame([(None, 4.0), (None, None), (None, 6.0)], "g string, v double")
    assert sorted(r[1] for r in missing.impute_median(lone, ["v"], by=["g"]).collect()) == [4.0, 5.0, 6.0]


def test_drop_incomplete(spark):
    df = spark.createDataFrame([(1, "x", None, None), (None, "x", None, None)], "a int, b string, c string, d string")
    assert missing.drop_incomplete(df, 0.5).count() == 1


# --- references ---------------------------------------------------------------------------------


LAGS = (0.0, 1.5, 599.999999, 600.0, 600.000001, 600.9, -600.0, -600.9, -3600.0)


def test_late_arrivals(spark):
    """Lags around the limit, to the microsecond; the stream's condition is the same."""
    pay = spark.createDataFrame([(i, T0 + timedelta(seconds=s)) for i, s in enumerate(LAGS)] + [(99, T0)], "order_id int, paid_at timestamp")
    orders = spark.createDataFrame([(i, T0) for i in range(len(LAGS))], "order_id int, ordered_at timestamp")
    out = {r["order_id"]: r for r in references.classify_late_arrivals(pay, orders, minutes=10).collect()}
    band = F.expr("INTERVAL 10 MINUTES")
    near = pay.join(orders, "order_id").filter(F.col("paid_at").between(F.col("ordered_at") - band, F.col("ordered_at") + band))
    joined = {r[0] for r in near.select("order_id").collect()}
    for i, lag in enumerate(LAGS):
        assert out[i]["_join_lag_sec"] == lag and out[i]["_join_result"] == ("joined" if i in joined else "late")
        assert (abs(lag) <= 600) == (i in joined)
    assert out[99]["_join_result"] == "waiting"
    assert out[5]["_dlq_reason"].startswith("payment 600.900s after") and out[8]["_dlq_reason"].startswith("payment 3600.000s before")


def test_missing_status_is_no_cancellation(spark):
    orders = spark.createDataFrame([(1, None), (2, "Cancelled"), (3, "pending"), (4, "returned")], "order_id int, status string")
    none = spark.createDataFrame([], "order_id int, payment_status string")
    paid = spark.createDataFrame([(i, "completed") for i in (1, 2, 3, 4)], "order_id int, payment_status string")
    assert rows(references.unpaid_orders(orders, none).select("order_id")) == [(1,), (3,), (4,)]
    assert rows(references.unshipped_paid_orders(orders, paid, none).select("order_id")) == [(1,), (3,)]


def test_unreadable_payments_are_reported(spark):
    orders = spark.createDataFrame([(1, "10.00"), (2, "10.00"), (3, "10.00")], "order_id int, due string")
    paid = spark.createDataFrame([(1, "10.00"), (2, "abc"), (2, "10.00"), (3, "9.00"), (3, None)], "o int, amount string")
    out = references.amount_mismatch(orders, "order_id", "due", paid, "o", "amount")
    assert rows(out.select("order_id", "delta", "unreadable")) == [(2, 0.0, 1), (3, -1.0, 0)]


def test_orphans_ignore_missing_references(spark, no_broadcast):
    child = spark.createDataFrame([(1, 10), (2, 99), (3, None)], "id int, parent_id int")
    parent = spark.createDataFrame([(10,), (10,)], "id int")
    assert rows(references.orphans(child, "parent_id", parent).select("id")) == [(2,)]
    assert rows(references.keep_referenced(child, "parent_id", parent).select("id")) == [(1,)]
    report = references.fk_report({"c": child, "p": parent}, [("c", "parent_id", "p"), ("c", "parent_id", "missing")])
    assert rows(report) == [("c", "parent_id", "p", 3, 1, 1)]


def test_self_reference(spark):
    cats = spark.createDataFrame([(1, None), (2, 1), (3, 77)], "id int, parent_category_id int")
    assert rows(references.fk_report({"categories": cats})) == [("categories", "parent_category_id", "categories", 3, 1, 1)]


# --- quality ------------------------------------------------------------------------------------


def test_split_required_loses_nothing(spark):
    df = spark.createDataFrame([(1, "CLEAN"), (2, None), (3, "DIRTY"), (None, "CLEAN"), (5, "QUARANTINE")], "id int, _quality_flag string")
    clean, dirty = quality.split_required(df, ["id"])
    assert [r[0] for r in clean.orderBy("id").collect()] == [1, 2]
    assert sorted(str(r[0]) for r in dirty.collect()) == ["3", "5", "None"]


def test_auto_fix_and_routing(spark):
    """Every mix of flag, SKU spelling, phone and price."""
    skus, phones, prices = (None, "SKU-QX77", "skuQX77-VN"), (None, "0123", "9" * 31), (None, -2.0, 8.0)
    data = [(i, f, s, p, a) for i, (f, s, p, a) in enumerate(
        (f, s, p, a) for f in ("CLEAN", "DIRTY", "QUARANTINE", None) for s in skus for p in phones for a in prices)]
    df = spark.createDataFrame(data, "id int, _quality_flag string, sku string, phone string, price double")
    rules = [quality.sku_format_variant(), quality.phone_too_long(), quality.null_rule("price"), quality.negative("price")]
    routed = quality.route_quality(quality.auto_fix(quality.tag_rules(df, rules)), F.lit(T0))
    parts = {k: {r["id"] for r in v.collect()} for k, v in quality.routed(routed).items()}
    by_id = {r["id"]: r for r in routed.collect()}
    for i, flag, sku, phone, price in data:
        wrong_sku, long_phone = sku == "skuQX77-VN", phone == "9" * 31
        fixed = flag == "DIRTY" and price == 8.0 and (wrong_sku or long_phone)
        where = "silver" if fixed or flag in ("CLEAN", None) else "dead_letter" if flag == "DIRTY" else "quarantine"
        row = by_id[i]
        assert i in parts[where] and (i in parts["auto_fixed"]) == fixed
        assert row["sku"] == ("SKU-QX77" if fixed and wrong_sku else sku)
        assert row["phone"] == (phone[:20] if fixed and long_phone else phone)
        assert row["_retry_count"] == (where == "dead_letter") and row["_dlq_ingested_at"] == (T0 if where == "dead_letter" else None)
    assert sum(len(parts[k]) for k in ("silver", "dead_letter", "quarantine")) == len(data)


def test_replay_stops(spark):
    df = spark.createDataFrame([
        (1, "DIRTY", "skuAB1", 1.0, 1), (2, "DIRTY", "SKU-A", None, 1), (3, "DIRTY", "skuAB1", 1.0, 3), (4, "DIRTY", "skuAB1", 1.0, 0),
    ], "id int, _quality_flag string, sku string, price double, _retry_count int")
    rules = [quality.sku_format_variant(), quality.null_rule("price")]
    accepted = spark.createDataFrame([(4,)], "id int")
    out = quality.replay_dead_letters(df, rules, ["id", "price"], accepted, ["id"], F.lit(T0))
    assert rows(out.select("id", "_route", "_retry_count")) == [(1, "silver", 1), (2, "dead_letter", 2)]


def test_dead_letter_shape(spark):
    a = spark.createDataFrame([(1, "x")], "id int, raw_data string")
    b = spark.createDataFrame([("QUARANTINE",)], "_quality_flag string")
    out = quality.dead_letters({"a": a, "b": b}, F.lit(T0))
    assert tuple(out.columns) == quality.DEAD_LETTER_COLUMNS
    assert rows(out.select("_source", F.coalesce("id", F.lit("-")), "_quality_flag")) == [("a", "1", "DIRTY"), ("b", "-", "QUARANTINE")]


def test_expectations_count_null_as_failure(spark):
    df = spark.createDataFrame([(1,), (None,), (-1,)], "v int")
    out = quality.expectations(df, {"positive": F.col("v") > 0, "small": F.coalesce("v", F.lit(0)) < 9})
    assert rows(out) == [("positive", 2, 3, False), ("small", 0, 3, True)]
    twins = spark.createDataFrame([(1, 5, 1.0), (1, 5, 1.0), (2, 5, 1.01), (3, 6, 1.0)], "id int, k int, v double")
    out = quality.expectations(twins, {"known": F.col("k").isNotNull()}, unique=twins.columns, near_keys=("id", ["k"], [], "v"))
    assert rows(out) == [("known", 0, 4, True), ("no_exact_duplicate", 1, 4, False), ("no_near_duplicate", 1, 3, False)]


def test_rule_library(spark):
    df = spark.createDataFrame(
        [(T0 + timedelta(days=800), "SPRIING...", " x", 0.0, "bitcoin", "Pho")],
        "at timestamp, title string, padded string, price double, payment_method string, name string")
    as_of = F.lit(T0)
    rules = [quality.future_created_at(as_of, "at"), quality.implausible_year("at", as_of), quality.zero_price(),
             quality.invalid_payment_method(), quality.truncated_name(), *quality.text_rules("title"), *quality.text_rules("padded")]
    assert df.transform(quality.tag_rules, rules).first()["_reasons"] == [
        "future_created_at", "implausible_year", "zero_price", "invalid_payment_method", "truncated_name",
        "cut_title", "doubled_vowel_title", "shouting_title", "hidden_space_padded"]


def test_repeat_flag_on_a_hot_value(hot, no_broadcast):
    out = quality.with_repeat_flag(hot, ["k"], "again")
    assert out.count() == 3000 and out.filter("k IS NULL AND again").count() == 0
    assert out.filter("k = 7 AND NOT again").count() == 0


# --- state --------------------------------------------------------------------------------------


def test_status_fold(spark):
    entity = spark.createDataFrame([(1, "pending"), (2, "pending"), (None, "pending")], "k int, status string")
    events = spark.createDataFrame([
        (1, "picked_up", T0, 1), (1, "delivered", T0 + timedelta(hours=1), 2), (1, "picked_up", T0 + timedelta(minutes=5), 3),
    ], "k int, status_to string, at timestamp, e int")
    out = {r["k"]: r for r in status.apply_status_events(entity, events, "k", "at", "e").collect()}
    assert (out[1]["status"], out[1]["shipped_at"], out[1]["delivered_at"]) == ("delivered", T0, T0 + timedelta(hours=1))
    assert out[2]["status"] == "pending" and out[None]["status"] == "pending"
    silent = spark.createDataFrame([(1, None, T0 + timedelta(days=1), 9)], events.schema)
    again = status.apply_status_events(entity, events.unionByName(silent), "k", "at", "e").filter("k = 1").first()
    assert again["status"] == "delivered"


def test_illegal_steps(spark):
    df = spark.createDataFrame([
        (1, "pending", T0, 1), (1, "processing", T0 + timedelta(hours=2), 2), (1, "delivered", T0 + timedelta(hours=5), 3),
        (1, "delivered", T0 + timedelta(hours=6), 4),
    ], "k int, s string, at timestamp, e int")
    out = status.illegal_transitions(df, ["k"], "s", "at", "e", vocab.ORDER_FLOW)
    assert rows(out.select("e", "_previous")) == [(3, "processing")]
    pairs = spark.createDataFrame([("pending", "failed"), ("failed", "refunded"), (None, "completed")], "status_from string, status_to string")
    assert status.illegal_pairs(pairs, vocab.PAYMENT_FLOW).count() == 2


# --- reports ------------------------------------------------------------------------------------


@pytest.mark.parametrize("age, verdict", [(59, "OK"), (60, "WARN"), (599, "WARN"), (600, "FAIL")])
def test_freshness(spark, age, verdict):
    df = spark.createDataFrame([(T0,), (T0 - timedelta(days=1),)], "at timestamp")
    assert reports.freshness(df, "at", F.lit(T0 + timedelta(seconds=age))).first()["status"] == verdict


def test_health_verdict(spark):
    checks = spark.createDataFrame([("OK",), ("WARN",), ("OK",)], "status string")
    assert rows(reports.health_verdict(checks)) == [(2, 1, 0, "WARN")]


def test_topic_stats(spark):
    bronze = spark.createDataFrame([("a", 0, 4), ("a", 1, 2)], "_source_topic string, _kafka_partition int, _kafka_offset bigint")
    out = {r["topic"]: r for r in reports.topic_stats(bronze, ["a", "b", "c.dlq"]).collect()}
    assert (out["a"]["messages"], out["a"]["end_offsets"], out["a"]["partitions"]) == (2, 8, 2)
    assert [out[t]["status"] for t in ("a", "b", "c.dlq")] == ["OK", "WARN", "OK"]
