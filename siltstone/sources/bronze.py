"""Landing: topics to bronze records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone import schemas, vocab


def whole_topic_matches(topic: Column, pattern: str) -> Column:
    return F.rlike(topic, F.lit(f"^(?:{pattern})$"))


def read_topics(
    spark: SparkSession, pattern: str, *, servers: str | None = None, files: str | None = None,
    starting: str = "earliest", fail_on_data_loss: bool = True, schema: str = schemas.MESSAGE,
    batch_messages: int = 50_000_000, batch_files: int = 10_000,
) -> DataFrame:
    """S1. A stream of messages from every topic whose whole name matches `pattern`.

    With `servers` the messages come from Kafka (topics may appear later); with `files` from a
    folder of Parquet messages that carry a `topic` column. A backlog is drained in micro-batches of at most
    `batch_messages` or `batch_files`; all of them are read.
    """
    if servers:
        return (
            spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", servers)
            .option("subscribePattern", pattern)
            .option("startingOffsets", starting)
            .option("failOnDataLoss", str(fail_on_data_loss).lower())
            .option("maxOffsetsPerTrigger", batch_messages)
            .load()
        )
    if files:
        messages = spark.readStream.schema(schema).option("maxFilesPerTrigger", batch_files).parquet(files)
        return messages.filter(whole_topic_matches(F.col("topic"), pattern))
    raise ValueError("give either servers or files")


def to_bronze(messages: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    """S2. Text of key and value with lineage, and the day as partition column."""
    return messages.select(
        F.col("value").cast("string").alias("raw_data"),
        F.col("key").cast("string").alias("kafka_key"),
        F.col("topic").alias("_source_topic"),
        F.col("partition").alias("_kafka_partition"),
        F.col("offset").alias("_kafka_offset"),
        F.col("timestamp").alias("_kafka_timestamp"),
        (F.current_timestamp() if ingested_at is None else ingested_at).alias("_bronze_ingested_at"),
        F.to_date("timestamp").alias("ingest_date"),
    )


def route_topic(topic: Column, routes: dict[str, str] = vocab.TOPIC_ROUTES) -> Column:
    """S4. Name of the landing table a topic belongs to, NULL for unknown topics."""
    return F.coalesce(*[F.when(whole_topic_matches(topic, p), F.lit(sink)) for sink, p in routes.items()])
