"""Historical snapshots."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.operators.dedup import latest_per_key
from siltstone.operators.parse import drop_deletes


def read_jdbc_table(
    spark: SparkSession, url: str, table: str, *, low: int, high: int, key: str = "id",
    partitions: int = 32, fetch: int = 50000, properties: Mapping[str, str] | None = None,
) -> DataFrame:
    """S12. A database table read in parallel ranges of its key; decimals stay decimals.

    `low` and `high` (the key's range) only place the cuts between ranges; no row is left out.
    """
    return spark.read.jdbc(
        url, table, column=key, lowerBound=low, upperBound=high, numPartitions=partitions,
        properties={"fetchsize": str(fetch), **(properties or {})},
    )


def tag_snapshot(df: DataFrame, system: str, table: str, loaded_at: Column) -> DataFrame:
    """S12. Load metadata on every row."""
    return df.withColumns({
        "_load_type": F.lit("historical"),
        "_source_system": F.lit(system),
        "_table_name": F.lit(table),
        "_loaded_at": loaded_at,
    })


def snapshot_manifest(tables: Mapping[str, DataFrame], taken_at: Column) -> DataFrame:
    """S13. One row per table: rows and snapshot time."""
    rows = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count", taken_at.alias("snapshot_time")
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, rows)


def merge_history(
    historical: DataFrame, cdc: DataFrame, key: Sequence[str], newest: str = "__source_ts_ms",
    ties: Sequence[str] = (),
) -> DataFrame:
    """S14. Current rows: history is trusted, any change wins over it, the newest change wins.

    History carries no change time and therefore sorts last; a key whose newest change is a delete
    disappears. `_load_type` tells where a row came from.
    """
    marked = cdc.withColumn("_load_type", F.lit("cdc"))
    old = historical if "_load_type" in historical.columns else historical.withColumn("_load_type", F.lit("historical"))
    both = old.unionByName(marked, allowMissingColumns=True)
    # "historical" > "cdc", so a change without a time must be told apart explicitly.
    ranked = both.withColumn("_is_change", F.col("_load_type") == "cdc")
    current = latest_per_key(ranked, key, "_is_change", [newest, *ties])
    return drop_deletes(current).drop("_is_change")
