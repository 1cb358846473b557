"""Bronze records to typed columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone import schemas

LINEAGE = ("_bronze_ingested_at", "_kafka_partition", "_kafka_offset")


def _lineage(df: DataFrame) -> list[str]:
    return [c for c in LINEAGE if c in df.columns]


def parse_cdc(bronze: DataFrame, topic: str, schema: str, *, deletes: str = "keep", raw: bool = False) -> DataFrame:
    """P1. Rows of one change topic, flattened.

    The topic is a partition column of the landing table, so filtering it first prunes folders.
    Deletes are kept by default: they may only be dropped after the latest version of a key is
    known (see `drop_deletes`).
    """
    parsed = bronze.filter(F.col("_source_topic") == topic).select(
        F.from_json("raw_data", schema).alias("row"),
        *_lineage(bronze),
        *(["raw_data"] if raw else []),
    )
    flat = parsed.select("row.*", *[c for c in parsed.columns if c != "row"])
    return drop_deletes(flat) if deletes == "drop" else flat


def drop_deletes(df: DataFrame) -> DataFrame:
    """P6. Drop rows that say they are deletes; a missing operation is not a delete."""
    gone = F.coalesce(F.col("__op") == "d", F.lit(False))
    if "__deleted" in df.columns:
        gone = gone | F.coalesce(F.lower("__deleted") == "true", F.lit(False))
    return df.filter(~gone)


def parse_flat_envelope(bronze: DataFrame, schema: str, *, raw: bool = False) -> DataFrame:
    """P2. One-level JSON: envelope fields and data fields side by side."""
    parsed = bronze.select(
        F.from_json("raw_data", schema).alias("row"),
        *_lineage(bronze),
        *(["raw_data"] if raw else []),
    )
    return parsed.select("row.*", *[c for c in parsed.columns if c != "row"])


def parse_nested_envelope(bronze: DataFrame, *, raw: bool = False) -> DataFrame:
    """P3. Envelope fields plus the payload as JSON text, from a single parse of the record."""
    wanted = f"{schemas.ENVELOPE_META}, payload string"
    return parse_flat_envelope(bronze, wanted, raw=raw).withColumnRenamed("payload", "payload_json")


def keep_event_types(df: DataFrame, types: Sequence[str]) -> DataFrame:
    """P5."""
    return df.filter(F.col("_event_type").isin(*types))


def parse_payload(envelopes: DataFrame, prefix: str, schema: str) -> DataFrame:
    """P4. Events whose type starts with `prefix`, payload parsed and laid beside the envelope."""
    meta = [c for c in envelopes.columns if c != "payload_json"]
    chosen = envelopes.filter(F.startswith("_event_type", F.lit(prefix))).select(
        F.from_json("payload_json", schema).alias("data"), *meta
    )
    return chosen.select("data.*", *meta)


def require_positive(df: DataFrame, column: str) -> DataFrame:
    """P7. Keep rows with a value above zero; missing values go too."""
    return df.filter(F.col(column) > 0)
