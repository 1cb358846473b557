"""Streaming landing, routing, dedup, joins and counts (S3, S16, K9, J7, hourly counts)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from siltstone import vocab


_KEPT = "spark.sql.streaming.numRecentProgressUpdates"


def _run(writer: DataStreamWriter, path: str, spark: SparkSession) -> int:
    """Start, wait for the end, and add up the rows of all batches, of which Spark keeps a hundred unless told otherwise."""
    before = spark.conf.get(_KEPT)
    spark.conf.set(_KEPT, str(1 << 30))
    try:
        query = writer.start(path)
        query.awaitTermination()
        return sum(p["numInputRows"] for p in query.recentProgress)
    finally:
        spark.conf.set(_KEPT, before)


def drain(stream: DataFrame, path: str, checkpoint: str, partition_by: Sequence[str] = ()) -> int:
    """Append everything available to a Parquet table, then stop; returns the rows read.

    The checkpoint records what was consumed and the file sink's log what was written, so a rerun
    or a retry after a lost executor adds nothing twice.
    """
    writer = (
        stream.writeStream.format("parquet").outputMode("append").trigger(availableNow=True)
        .option("checkpointLocation", checkpoint)
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return _run(writer, path, stream.sparkSession)


def append_bronze(bronze: DataFrame, path: str, checkpoint: str) -> int:
    """S3. Land bronze records by topic and day."""
    return drain(bronze, path, checkpoint, ["_source_topic", "ingest_date"])


def split_stream(stream: DataFrame, route: Column, path: str, checkpoint: str) -> int:
    """S16 / Q4 on a stream. Every branch is a folder `_route=<name>` of one table.

    One query reads the input once; the exactly-once file sink does the splitting.
    """
    return drain(stream.withColumn("_route", route), path, checkpoint, ["_route"])


def dlq_route(main: str, flag: str = "_quality_flag") -> Column:
    """S16. DIRTY events go to the stream's `.dlq` twin."""
    dirty = F.coalesce(F.col(flag), F.lit(vocab.CLEAN)) == vocab.DIRTY
    return F.when(dirty, F.lit(f"{main}.dlq")).otherwise(F.lit(main))


def dedup_stream(stream: DataFrame, keys: Sequence[str], at: str, delay: str = "10 minutes") -> DataFrame:
    """K9. Drop repeats of a key; state is bounded by the watermark."""
    return stream.withWatermark(at, delay).dropDuplicatesWithinWatermark(list(keys))


def late_arrival_stream(
    payments: DataFrame, orders: DataFrame, key: str, paid_at: str, ordered_at: str,
    minutes: int = vocab.LATE_MINUTES, delay: str | None = None, *, salts: int = 1,
) -> DataFrame:
    """J7. Payments left-joined with orders at most `minutes` apart, both ways.

    A payment without an order comes out (with NULLs) once the watermark rules a match out: those
    are the dead letters; payments still in state are the waiting ones. Where single orders have very many payments,
    `salts` spreads each order over so many state partitions: each payment has one salt, each order is kept once per salt.
    """
    delay = delay or f"{minutes} minutes"
    left_key, right_key = f"_pay_{key}", f"_ord_{key}"
    left = payments.withColumn("_salt_p", F.pmod(F.xxhash64(*payments.columns), F.lit(salts)).cast("int"))
    left = left.withColumnRenamed(key, left_key).withWatermark(paid_at, delay)
    right = orders.withColumnRenamed(key, right_key).withWatermark(ordered_at, delay).withColumn(
        "_salt_o", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    )
    band = F.expr(f"INTERVAL {minutes} MINUTES")
    matched = (
        (F.col(left_key) == F.col(right_key))
        & (F.col("_salt_p") == F.col("_salt_o"))
        & (F.col(paid_at) >= F.col(ordered_at) - band)
        & (F.col(paid_at) <= F.col(ordered_at) + band)
    )
    joined = left.join(right, matched, "left")
    return joined.withColumnRenamed(left_key, key).drop(right_key, "_salt_p", "_salt_o")


def event_counts(
    stream: DataFrame, at: str, by: Sequence[str], width: str = "1 hour", delay: str = "10 minutes"
) -> DataFrame:
    """Tumbling-window counts; a window is final once the watermark has passed its end."""
    return (
        stream.withWatermark(at, delay)
        .groupBy(F.window(at, width), *by)
        .agg(F.count(F.lit(1)).alias("events"))
        .select(F.col("window.start").alias("window_start"), *by, "events")
    )
