"""Joins and look-backs that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Pieces that a key's rows are dealt to where a key is worked on in pieces.
SALTS = 64


def skew_join(big: DataFrame, unique: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join `big` with a side that has one row per key.

    `how` is any join that keeps or drops rows of `big`: inner, left, left_semi, left_anti. Missing keys never match. It is a plain join: Spark
    broadcasts a small `unique`, and at run time splits the partitions of `big` in which a hot key lies.
    """
    return big.join(unique, list(keys), how)


def previous_value(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    at: str,
    tie: str,
    *,
    chunk: str = "HOUR",
    into: str = "_previous",
) -> DataFrame:
    """The value of the preceding row of the same key, in (at, tie) order.

    A key's history is cut into time chunks so that a hot key is sorted by many tasks. Inside a
    chunk this is a plain `lag`; the first row of a chunk takes the last value of the chunk before. Those last
    values come from the same sorted chunks, one row each, so the input is read and shuffled once.
    Rows without a key are one history, as in a window.
    """
    packed = F.struct(*[F.col(k) for k in keys])  # a struct key matches on NULL
    cut = df.withColumns({"_key": packed, "_chunk": F.date_trunc(chunk, F.col(at).cast("timestamp"))})
    within = Window.partitionBy("_key", "_chunk").orderBy(at, tie)
    lagged = cut.withColumns({
        "_inside": F.lag(value).over(within),
        "_first": F.row_number().over(within) == 1,
        "_end": F.lead(F.lit(True)).over(within).isNull(),
    })
    chunks = Window.partitionBy("_key").orderBy("_chunk")
    ends = lagged.filter("_end").select("_key", "_chunk", F.struct(F.col(value).alias("v")).alias("_last"))
    carried = ends.select(
        F.col("_key").alias("_its_key"), F.col("_chunk").alias("_its_chunk"), F.lag("_last").over(chunks)["v"].alias("_carried"))
    same = (F.col("_key") == F.col("_its_key")) & F.col("_chunk").eqNullSafe(F.col("_its_chunk"))
    joined = lagged.join(carried, same, "left")
    return joined.withColumn(into, F.when(F.col("_first"), F.col("_carried")).otherwise(F.col("_inside"))).select(*df.columns, into)
