"""Sketches, reconciliation by content, learned typos, versions over time, metrics from writes, the checks after cleaning."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from siltstone.operators import history, quality, reports, sketches, typos
from siltstone.operators.dedup import near_duplicates, near_twin_sums
from siltstone.operators.reconcile import reconcile_rows
from siltstone.sources.versions import VersionedTable


def day(n):
    return datetime.date(2024, 1, n)


@pytest.mark.parametrize("shape", ["even", "skewed", "few"])
def test_merged_quantiles_are_within_the_stated_error(spark, tmp_path, shape):
    value = {"even": F.rand(5), "skewed": F.exp(F.randn(5) * 3), "few": F.floor(F.rand(5) * 6).cast("double")}[shape]
    rows = spark.range(0, 200_000, 1, 7).select(F.when(F.col("id") % 50 != 3, value).alias("v"), F.expr("date_add(DATE '2024-01-01', CAST(id % 20 AS INT))").alias("d")).cache()
    table = VersionedTable(spark, str(tmp_path / "sketches"))
    sketches.update_sketches(table, rows.filter("d < '2024-01-12'"), "v", "d")
    sketches.update_sketches(table, rows.filter("d >= '2024-01-10'"), "v", "d", since=day(10))  # reads no earlier day
    sketches.update_sketches(table, rows.filter("d >= '2024-01-10'"), "v", "d", since=day(10))
    wanted = [0.01, 0.25, 0.5, 0.75, 0.99]
    found = sketches.merged_quantiles(table.read(), wanted).first()
    values = sorted(r[0] for r in rows.filter("v IS NOT NULL").select("v").collect())
    assert found["n"] == len(values) and table.read().count() == 20
    for p, v in zip(wanted, found["quantiles"]):
        below, upto = sum(x < v for x in values) / len(values), sum(x <= v for x in values) / len(values)
        assert below - sketches.rank_error() <= p <= upto + sketches.rank_error()
    assert sketches.rank_error() < 0.004
    row = sketches.merged_iqr_bounds(table.read()).first()
    assert row["high"] - row["q3"] == pytest.approx(1.5 * row["iqr"]) and row["low"] == pytest.approx(row["q1"] - 1.5 * row["iqr"])


def test_sketches_of_nothing(spark):
    empty = spark.createDataFrame([(None, day(1)), (float("nan"), day(2))], "v double, d date")
    assert sketches.day_sketches(empty, "v", "d").count() == 0
    assert sketches.merged_quantiles(sketches.day_sketches(empty, "v", "d"), [0.5]).collect() == [(None, 0)]


def reconciled(spark, left, right, key=("k",), schema="k int, a string, b double", **more):
    found = reconcile_rows(spark.createDataFrame(left, schema), spark.createDataFrame(right, schema), list(key), **more)
    return sorted((tuple(r) for r in found.collect()), key=str)


@pytest.mark.parametrize("bits", [1, 10])
def test_rows_that_differ_are_named(spark, no_broadcast, bits):
    left = [(k, f"a{k}", float(k)) for k in range(300)] + [(None, "x", 1.0), (500, None, None), (501, None, 0.0), (600, "t", 1.0), (600, "t", 1.0), (601, "u", 1.0), (601, "v", 1.0)]
    right = [r for r in left if r[0] not in (7, 8, 501, 600, 601)] + [(7, "a7", 7.5), (501, "", None), (600, "t", 1.0), (601, "u", 1.0), (601, "w", 1.0), (900, "n", 2.0)]
    assert reconciled(spark, left, right, bits=bits) == sorted([
        (7, "changed", 1, 1, ["b"]), (8, "missing", 1, 0, None), (501, "changed", 1, 1, ["a", "b"]), (600, "changed", 2, 1, None),
        (601, "changed", 2, 2, None), (900, "extra", 0, 1, None)], key=str)
    assert reconciled(spark, left, list(reversed(left)), bits=bits) == []
    assert reconciled(spark, [], [], bits=bits) == []


def test_null_keys_and_swapped_values_are_told(spark):
    assert reconciled(spark, [(None, "x", 1.0)], [(None, "y", 1.0)]) == [(None, "changed", 1, 1, ["a"])]
    assert reconciled(spark, [(1, "x", 1.0), (2, "y", 1.0)], [(1, "y", 1.0), (2, "x", 1.0)]) == [(1, "changed", 1, 1, ["a"]), (2, "changed", 1, 1, ["a"])]
    assert reconciled(spark, [(1, None, None)], [(1, None, 0.0)]) == [(1, "changed", 1, 1, ["b"])]
    only = reconcile_rows(spark.range(5), spark.range(1, 6), ["id"])
    assert sorted((r["id"], r["state"]) for r in only.collect()) == [(0, "missing"), (5, "extra")]


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def test_typos_against_all_pairs(spark, no_broadcast):
    draw, counts = random.Random(3), {}
    for base in ("processing", "pending", "ab", "a", "shipped", "delivered", "x" * 64, "y" * 70):
        counts[base] = 40
        for _ in range(8):
            w = list(base)
            for _ in range(draw.randrange(1, 4)):
                i = draw.randrange(len(w) + 1)
                w[i:i + draw.randrange(2)] = draw.choice(["", "q", "é"])
            counts.setdefault("".join(w).strip() or "z", draw.choice([1, 3, 4, 5]))
    rows = [(f" {w.upper()} " if k % 2 else w,) for k, (w, n) in enumerate(counts.items()) for _ in range(n)] + [(None,), ("  ",)]
    df = spark.createDataFrame(rows, "w string")
    want = []
    for a, n in counts.items():
        near = [(edits(a, b), -m, b) for b, m in counts.items() if b != a and m >= 10 * n and edits(a, b) <= 2 and len(a) <= 64 and len(b) <= 64]
        if near:
            d, m, b = min(near)
            want.append((a, n, b, -m, d))
    found = typos.learn_typos(df, "w")
    assert sorted(map(tuple, found.collect())) == sorted(want) and len(want) > 10
    fixed = typos.apply_typos(df, "w", found)
    assert fixed.count() == df.count() and fixed.columns == ["w"]
    told = dict((w[0], w[2]) for w in want)
    left = {(r["w"] or "").strip().lower() for r in fixed.collect()}
    assert not left & told.keys()


def at(hours):
    return datetime.datetime(2024, 1, 31, 22) + datetime.timedelta(hours=hours)


def test_states_and_facts_of_their_time(spark, no_broadcast):
    changes = spark.createDataFrame([
        ("a", at(0), 1, "x", False), ("a", at(0), 2, "y", False), ("a", at(5), 3, "z", False), ("a", at(9), 4, None, True), ("a", at(60), 5, "w", False),
        ("b", at(1), 6, "q", True), ("c", None, 7, "q", False), (None, at(1), 8, "q", False)], "k string, t timestamp, n int, v string, gone boolean")
    states = history.validity(changes, "k", "t", ["n"], deleted="gone")
    assert sorted((r["k"], r["v"], r["valid_from"], r["valid_to"], r["is_current"]) for r in states.collect()) == [
        ("a", "w", at(60), None, True), ("a", "y", at(0), at(5), False), ("a", "z", at(5), at(9), False)]
    facts = spark.createDataFrame([(i, k, t) for i, (k, t) in enumerate([
        ("a", at(-1)), ("a", at(0)), ("a", at(4)), ("a", at(5)), ("a", at(8)), ("a", at(9)), ("a", at(30)), ("a", at(60)), ("a", at(24 * 90)),
        ("b", at(2)), ("d", at(2)), (None, at(2)), ("a", None), ("a", at(4))])], "i int, k string, f timestamp")
    for chunk in ("HOUR", "DAY", "MONTH", "YEAR"):
        found = history.as_of(facts, states.select("k", "v", "valid_from", "valid_to"), "k", "f", chunk=chunk)
        assert [r["v"] for r in found.orderBy("i").collect()] == [None, "y", "y", "z", "z", None, None, "w", "w", None, None, None, None, "y"]
        assert found.columns == ["i", "k", "f", "v", "valid_from", "valid_to"]
    assert history.as_of(facts, states.select("k", "v", "valid_from"), "k", "f", valid_to=None).filter("i = 6").first()["v"] == "z"
    with pytest.raises(ValueError):
        history.as_of(facts.withColumn("v", F.lit(1)), states, "k", "f")


def test_a_write_tells_what_it_has_seen(spark, tmp_path):
    rows = spark.range(10).select("id", F.when(F.col("id") < 3, "dead_letter").otherwise("silver").alias("_route"))
    found = reports.observed_quality_counts({"a": rows, "b": rows.filter("id > 4")}, str(tmp_path / "w"))
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, reports.quality_counts({"a": rows, "b": rows.filter("id > 4")}).collect()))
    assert spark.read.parquet(str(tmp_path / "w" / "a")).count() == 10
    seen = reports.write_observed({"a": rows.select("id")}, str(tmp_path / "x"), {"a": {"top": F.max("id"), "n": F.count(F.lit(1))}})
    assert seen == {"a": {"top": 9, "n": 10}}


def test_twin_sums_agree_with_the_rows(spark):
    draw = random.Random(9)
    rows = [(draw.choice([None, 1, 2, 3, 4, 5, 5]), draw.choice([None, 1, 2]), draw.choice(["a", "A ", None]), draw.choice([1.0, 1.005, 1.01, 1.02, 2.0, None])) for _ in range(400)]
    df = spark.createDataFrame(rows, "id int, k int, s string, amount double").distinct()
    one = near_twin_sums(df, {"rows": F.lit(1), "low": F.when(F.col("amount") < 1.01, 1).otherwise(0)}, "id", ["k"], ["s"], "amount").agg(
        *[F.sum(c) for c in ("rows", "low", "_twins")]).first()
    twins = near_duplicates(df, "id", ["k"], ["s"], "amount").count()
    assert tuple(one) == (df.count(), df.filter("amount < 1.01").count(), twins) and twins > 20


def test_checks_are_left_out_without_their_columns(spark):
    df = spark.createDataFrame([(1, "A", 6, None), (1, "A", 6, None), (2, "b", None, 5)], "id int, c string, rating int, p int")
    parents = spark.createDataFrame([(5,)], "id int")
    found = quality.checklist(df, quality.Checklist(required=["c"], rating="rating", categories=["c"], unique=True, references={"p": (parents, "id"), "id": (parents, "id")}))
    assert [tuple(r) for r in found.collect()] == [
        ("required_present", 0, 3, True), ("rating_in_range", 2, 3, False), ("lower_case", 2, 3, False), ("no_exact_duplicate", 1, 3, False), ("references_exist", 3, 3, False)]
    assert [r["check"] for r in quality.checklist(df.limit(0), quality.Checklist(required=["c"])).collect()] == ["required_present"]


@pytest.mark.parametrize("amount", ["CAST(id * 7 AS DOUBLE)", "CASE WHEN id < 0 THEN 1.0D END"], ids=["amounts", "no amounts"])
def test_twin_sums_of_one_key_are_worked_out_by_many_tasks(spark, amount):
    df = spark.range(4000).selectExpr("id", "concat('a', id % 1) AS k", "concat('s', id % 2) AS s", f"{amount} AS amount").repartition(4, "k")
    parts = near_twin_sums(df, {"rows": F.lit(1)}, "id", ["k"], ["s"], "amount")
    plan = parts._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan
    held = parts.groupBy(F.spark_partition_id()).agg(F.sum("rows").alias("n")).collect()
    assert sum(r["n"] for r in held) == 4000 and max(r["n"] for r in held) < 2000
    assert parts.agg(F.sum("_twins")).first()[0] == 0


def test_checks_of_rows_joined_by_one_key_are_worked_out_by_many_tasks(spark, no_broadcast):
    rows = spark.range(4000).selectExpr("id", "7 AS k", "CAST(id * 7 AS DOUBLE) AS amount")
    joined = rows.join(spark.createDataFrame([(7,)], "k int"), "k")
    found = quality.expectations(joined, {"known": F.col("k").isNotNull()}, unique=joined.columns, near_keys=("id", ["k"], [], "amount"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(_groupingexpression") == 1 and plan.count("_band") > 0
    assert sorted((r["check"], r["failed"]) for r in found.collect()) == [("known", 0), ("no_exact_duplicate", 0), ("no_near_duplicate", 0)]
