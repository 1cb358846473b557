"""Parent references of a table to itself."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.session import kept

OK, ORPHAN, CYCLE, INTO_CYCLE, NO_ID = "ok", "orphaned", "cycle", "into_cycle", "no_id"


def hierarchy(df: DataFrame, row_id: str, parent: str, keep: Callable[[DataFrame, str], DataFrame] = kept) -> DataFrame:
    """J5 for a self-reference: (row_id, parent, depth, root, state), one row for each row of `df`.

    `ok`: the chain of parents ends at a row without one, `root`, after `depth` steps; `orphaned`: it ends at a reference that points
    nowhere, and `root` is the last row before; `cycle`: the row comes back to itself; `into_cycle`: its chain ends in one, so that
    neither has a depth or root; `no_id`: the row can't be referred to. Where several rows have one id, the smallest of their parents is what
    references to it follow.

    By pointer jumping: in each round every open row takes over where its pointer's row points, so that a chain of n steps takes
    log2(n) rounds, each an equi-join with one row for each id on one side. Rows are open until their chain has ended; once a round
    ends none, what is open leads into cycles, and jumps on until only the rows of cycles are pointed at. `keep` stores a
    round's rows, in the folder the cluster shares unless another is given. Jobs run while the result is built.
    """
    kind = df.schema[row_id].dataType
    rows = df.select(F.col(row_id).alias("id"), F.col(parent).cast(kind).alias("parent"))
    heads = rows.filter(F.col("id").isNotNull()).groupBy("id").agg(F.min("parent").alias("next"))
    known = heads.select(F.col("id").alias("next"), F.lit(True).alias("_known"))
    # A reference that points nowhere ends the chain like none does, but not in the same state.
    start = heads.join(known, "next", "left").select(
        "id", F.when(F.col("_known"), F.col("next")).alias("next"), F.lit(0).cast("bigint").alias("depth"), F.col("id").alias("top"),
        (F.col("next").isNotNull() & F.col("_known").isNull()).alias("lost"))
    now = keep(start.select("id", "next", F.when(F.col("next").isNull(), F.col("depth")).otherwise(F.lit(1)).alias("depth"),
                            F.coalesce("next", "top").alias("top"), "lost"), "hierarchy")
    # `next` is the row that the chain goes on from, None if `top` ends it; `depth` counts the steps to `top`.
    left = now.filter(F.col("next").isNotNull()).count()
    while left:
        now = _jump(now, keep)
        still = now.filter(F.col("next").isNotNull()).count()
        if still == left:
            break
        left = still
    ended = now.filter(F.col("next").isNull()).select("id", "depth", F.col("top").alias("root"), F.when(F.col("lost"), ORPHAN).otherwise(OK).alias("state"))
    if left:
        loops, size = now.filter(F.col("next").isNotNull()), None
        while True:
            targets = loops.select(F.col("next").alias("id")).distinct()
            if size == (size := targets.count()):
                break
            loops = _jump(loops, keep)
        on = targets.withColumn("_on", F.lit(True))
        ended = ended.unionByName(loops.select("id").join(on, "id", "left").select(
            "id", F.lit(None).cast("bigint").alias("depth"), F.lit(None).cast(kind).alias("root"),
            F.when(F.col("_on"), CYCLE).otherwise(INTO_CYCLE).alias("state")))
    found = rows.join(ended, "id", "left").withColumn("state", F.coalesce("state", F.lit(NO_ID)))
    return found.select(F.col("id").alias(row_id), F.col("parent").alias(parent), "depth", "root", "state")


def _jump(now: DataFrame, keep: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """Every open row goes on from where its pointer's row has got to."""
    there = now.select(F.col("id").alias("next"), F.col("next").alias("_next"), F.col("depth").alias("_depth"), F.col("top").alias("_top"), F.col("lost").alias("_lost"))
    met = now.filter(F.col("next").isNotNull()).join(there, "next").select(
        "id", F.col("_next").alias("next"), (F.col("depth") + F.col("_depth")).alias("depth"), F.col("_top").alias("top"), F.col("_lost").alias("lost"))
    return keep(met.unionByName(now.filter(F.col("next").isNull())), "hierarchy")


def hierarchy_report(found: DataFrame) -> DataFrame:
    """(state, rows, deepest) of a `hierarchy`."""
    return found.groupBy("state").agg(F.count(F.lit(1)).alias("rows"), F.max("depth").alias("deepest"))
