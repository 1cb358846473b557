"""Shards of near-equal bytes: a range partition whose splitters come from a size-weighted sample.

Records are ordered by (digest of the text, doc_id, row), so equal texts stand together and no key is ever repeated: a group of
copies that holds a third of all rows is cut like any other range. Ranges that turn out overfull get splitters of their own.
With the ranges counted, each record's byte offset in the whole order is its range's offset plus a running sum inside it, and
decides its shard. Only built-in functions; nothing but splitters and range sums comes to the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.llm.frames import stored

SHARDS = 8
RANGES = 256  # at least
RANGE_ROWS = 4_000_000  # of a range, which one task sorts
SAMPLE = 8192  # keys drawn at once, at least
PER_RANGE = 32  # keys drawn for each range; with the ranges' sums they are all that the driver holds
OVERFULL = 2  # times the mean of the ranges
_KEY = ("digest", "doc_id", "row")


def _draw(rows: DataFrame, sample: int, total: int) -> list[tuple]:
    """A weighted sample without replacement of `rows` with `total` bytes: the smallest -ln(u) / size, with u from a hash of the key.

    About twice as many as are wanted lie below the cutoff, so that no more than that leaves the tasks.
    """
    u = (F.shiftrightunsigned(F.xxhash64(*_KEY), 11) + 1) / F.lit(float(1 << 53) + 1)
    lot = -F.log(u) / F.col("size")
    near = rows.withColumn("lot", lot).where(F.col("lot") <= 2.0 * sample / max(total, 1) + 1e-300)
    return [tuple(r) for r in near.orderBy("lot", *_KEY).limit(sample).select(*_KEY).collect()]


def _sort_key(key: tuple):
    return key[0], key[1] is not None, key[1] if key[1] is not None else 0, key[2]


def _range_of(splitters: list[tuple], rows: DataFrame) -> Column:
    """How many splitters are at or below a row's key: a binary search among literals."""
    if not splitters:
        return F.lit(0)
    kind = rows.schema["doc_id"].dataType
    literals = F.array(*[
        F.struct(F.lit(d).alias("digest"), F.lit(i).cast(kind).alias("doc_id"), F.lit(r).cast("long").alias("row")) for d, i, r in splitters])
    steps, step = [], 1
    while step <= len(splitters):
        steps.insert(0, step)
        step *= 2
    below = lambda at: (at <= len(splitters)) & (F.get(literals, at - 1) <= F.struct(*_KEY))
    return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), lambda low, s: F.when(below(low + s), low + s).otherwise(low))


def shard_by_bytes(docs: DataFrame, shards: int = SHARDS, ranges: int = RANGES, sample: int = SAMPLE, range_rows: int = RANGE_ROWS) -> DataFrame:
    """For each row of `docs` (doc_id, text, anything else): doc_id, size, text_crc32, shard, slot.

    `size` is the text's UTF-8 bytes plus 1. Shards are consecutive in the order and differ in bytes by less than two
    records. `slot` counts from 0 in each shard without gaps. A null text has size 1 and the checksum of no bytes, 0; a null
    doc_id sorts first among equal texts. Repeated rows are records of their own. There are as many ranges as it takes for one to hold
    `range_rows` rows on average, `ranges` at least. Other columns are left out; an empty
    table gives an empty result.
    """
    text = F.coalesce("text", F.lit(""))
    rows = stored(docs.select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.md5(text).alias("digest"), F.monotonically_increasing_id().alias("row")), "records")
    total, count = rows.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()
    ranges = max(ranges, -(-count // range_rows))
    sample = max(sample, PER_RANGE * ranges)
    drawn = sorted(_draw(rows, sample, total), key=_sort_key)
    splitters = sorted({drawn[len(drawn) * k // ranges] for k in range(1, ranges)}, key=_sort_key) if drawn else []
    while True:
        ranged = rows.withColumn("range", _range_of(splitters, rows))
        held = {r["range"]: (r["bytes"], r["n"]) for r in ranged.groupBy("range").agg(
            F.sum("size").alias("bytes"), F.count("*").alias("n")).collect()}
        overfull = [k for k, (size, n) in held.items() if n > 1 and size * ranges > OVERFULL * total + ranges * size / n]
        if not overfull:
            break
        drawn = sorted(_draw(ranged.where(F.col("range").isin(overfull)), sample, sum(held[k][0] for k in overfull)), key=_sort_key)
        step = max(1, len(drawn) // (2 * OVERFULL * len(overfull)))
        more = set(drawn[step::step]) | set(drawn[len(drawn) // 2:][:1])
        if more <= set(splitters):
            break
        splitters = sorted({*splitters, *more}, key=_sort_key)

    offsets, ranks, at, rank = [], [], 0, 0
    for k in range(len(splitters) + 1):
        offsets.append(at)
        ranks.append(rank)
        at, rank = at + held.get(k, (0, 0))[0], rank + held.get(k, (0, 0))[1]
    inside = Window.partitionBy("range").orderBy(*_KEY)
    of_range = lambda values: F.get(F.array(*[F.lit(v).cast("long") for v in values]), F.col("range"))
    placed = ranged.select(
        "doc_id", "size", "text_crc32",
        (of_range(offsets) + F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")).alias("offset"),
        (of_range(ranks) + F.row_number().over(inside) - 1).alias("rank"))
    shard = F.least(F.floor(F.col("offset") / F.lit(max(total, 1)) * shards), F.lit(shards - 1)) if total > 1 << 58 else F.expr(f"offset * {shards}L div {max(total, 1)}L")
    placed = stored(placed.withColumn("shard", shard.cast("int")), "placed")
    first = {r["shard"]: r["first"] for r in placed.groupBy("shard").agg(F.min("rank").alias("first")).collect()}
    start = F.get(F.array(*[F.lit(first.get(k, 0)).cast("long") for k in range(shards)]), F.col("shard"))
    return placed.select("doc_id", "size", "text_crc32", "shard", (F.col("rank") - start).alias("slot"))
