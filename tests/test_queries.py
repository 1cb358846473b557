"""Every registered query against its DuckDB statement on the smallest tables."""

import os
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as contract
from checks.compare import rows_of
from workload.registry import ORACLES, QUERIES, TABLES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="given tables are not here")


@pytest.fixture(scope="module")
def duck():
    db = duckdb.connect()
    db.execute("SET TimeZone='UTC'")
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{FOLDER}/{t}.parquet')")
    return db


@pytest.mark.parametrize("name", list(contract.queries()))
def test_query(spark, duck, name):
    frame = contract.queries()[name](spark, FOLDER)
    got = rows_of(frame.columns, [tuple(r) for r in frame.collect()])
    statement = contract.oracle_sql().get(name)
    if statement is None:
        assert got[1]
        return
    found = duck.execute(statement)
    assert got == rows_of([d[0] for d in found.description], found.fetchall())


#: Queries that write a table or drain a stream first, and the training-data queries, which work in stored steps.
STEPS = {n for n in contract.queries() if n.startswith(("stream_", "op", "bronze_", "pipeline"))} | {
    "topic_subscribe", "gold_partition_counts", "corrupt_split", "csv_multiline", "json_array", "read_or_empty", "list_tables", "silver_incremental",
    "silver_odd_keys", "replay_states", "table_versions", "category_tree", "observed_quality", "iqr_bounds_merged"}


@pytest.mark.parametrize("name", [n for n in contract.queries() if n not in STEPS])
def test_building_a_query_runs_nothing(spark, no_broadcast, name):
    spark.sparkContext.setJobGroup(f"build {name}", name)
    try:
        contract.queries()[name](spark, FOLDER)
        jobs = list(spark.sparkContext.statusTracker().getJobIdsForGroup(f"build {name}"))
    finally:
        spark.sparkContext._jsc.clearJobGroup()
    opened = len([t for t in TABLES if os.path.exists(f"{FOLDER}/{t}.parquet")])
    assert len(jobs) <= opened, "more than one footer read for each table"


@pytest.mark.parametrize("missing", ["ahocorasick", "public_tokenizers", "siltstone.llm"])
def test_other_queries_are_there_without_the_training_data_operators(missing):
    """In a process of its own, where one thing that the operators need can't be imported."""
    hide = f"import sys; sys.modules[{missing!r}] = None; import __spark_entry__ as c; print(len(c.queries()), len(c.oracle_sql()), any(n.startswith('op1_') for n in c.queries()))"
    root = os.path.dirname(os.path.abspath(contract.__file__))
    found = subprocess.run([sys.executable, "-c", hide], cwd=root, capture_output=True, text=True, check=True).stdout.split()
    assert int(found[0]) >= len(QUERIES) and int(found[1]) >= len(ORACLES)
    assert found[2] == "False" or missing == "public_tokenizers"


def test_entry(spark):
    assert contract.entry(spark).columns == ["order_year", "order_month", "total_items", "total_revenue"]
