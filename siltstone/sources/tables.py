"""Tables written and registered."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


#: Whether the catalogue lists each partition with a place of its own; without, a table's location says it all.
_TRACKED = "spark.sql.hive.manageFilesourcePartitions"


def overwrite_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """S6. Full rebuild of a Parquet folder in place; see `VersionedTable` for one that readers never miss."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def ensure_database(spark: SparkSession, database: str, location: str | None = None) -> None:
    """S8."""
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`{place}")


def list_tables(spark: SparkSession, database: str) -> DataFrame:
    """S8. Names and types of the database's tables."""
    rows = [(t.name, t.tableType) for t in spark.catalog.listTables(database) if not t.isTemporary]
    return spark.createDataFrame(rows, "table_name string, table_type string")


def publish(df: DataFrame, database: str, name: str, path: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """S7. Write an external Parquet table and register it; returns the registered table.

    Partitioned tables are rebalanced on their partition columns first: AQE merges small pieces and
    splits a partition value that holds much of the data, so files come out even.

    The rows are written to a folder of their own below `path` first. A table of that name goes on with its old folder until then, and is
    switched to the new one by a change of its location, without a moment at which it is gone; only where its columns
    change is it dropped and made anew. Old folders stay, for queries that still read them.
    """
    spark = df.sparkSession
    table, place = f"`{database}`.`{name}`", f"{path.rstrip('/')}/{uuid.uuid4().hex}"
    shaped = df.hint("rebalance", *[F.col(c) for c in partition_by]) if partition_by else df
    shaped.write.partitionBy(*partition_by).parquet(place)
    others = [f for f in df.schema if f.name not in partition_by]
    shape = [(f.name, f.dataType) for f in [*others, *[df.schema[c] for c in partition_by]]]
    if spark.catalog.tableExists(table):
        known = spark.table(table).schema
        if [(f.name, f.dataType) for f in known] == shape and spark.conf.get(_TRACKED) == "false":
            spark.sql(f"ALTER TABLE {table} SET LOCATION '{place}'")
            spark.catalog.refreshTable(table)
            return spark.table(table)
        spark.sql(f"DROP TABLE {table}")
    columns = ", ".join(f"`{c}` {t.simpleString()}" for c, t in shape)
    parts = f" PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})" if partition_by else ""
    spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet{parts} LOCATION '{place}'")
    if partition_by and spark.conf.get(_TRACKED) == "true":
        spark.sql(f"MSCK REPAIR TABLE {table}")
    return spark.table(table)
