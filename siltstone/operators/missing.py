"""Missing values (M1-M6)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone import vocab
from siltstone.functions.text import blank_to_null, strip_control
from siltstone.operators.quantiles import quantiles


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def placeholders_to_null(
    df: DataFrame, columns: Sequence[str] | None = None,
    words: Sequence[str] = vocab.PLACEHOLDERS, *, trim: bool = True,
) -> DataFrame:
    """M1. All text columns by default; names the frame does not have are ignored."""
    wanted = text_columns(df) if columns is None else [c for c in columns if c in df.columns]
    return df.withColumns({c: blank_to_null(F.col(c), words, trim=trim) for c in wanted})


def trim_text(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """T1 on every text column."""
    wanted = text_columns(df) if columns is None else list(columns)
    return df.withColumns({c: strip_control(F.col(c)) for c in wanted})


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """M2. `(column_name, missing)`: NULL or empty values per column, all columns in one pass."""
    wanted = list(columns or df.columns)
    text = set(text_columns(df))
    counts = df.agg(*[
        F.count_if(F.col(c).isNull() | (F.col(c) == "") if c in text else F.col(c).isNull()).alias(c)
        for c in wanted
    ])
    return counts.unpivot([], wanted, "column_name", "missing")


def fill_constants(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """M3."""
    return df.na.fill(dict(values))


def impute_median(
    df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), *,
    accuracy: int | None = None,
) -> DataFrame:
    """M4. NULLs of numeric columns replaced by the column's (or the group's) median. Rows whose group is NULL are a group."""
    if not by:
        filled = {}
        for c in columns:
            median = quantiles(df, c, [0.5], accuracy=accuracy).select(
                F.col("quantiles")[0]
            ).scalar()
            filled[c] = F.coalesce(F.col(c), median.cast(df.schema[c].dataType))
        return df.withColumns(filled)
    out = df
    for c in columns:
        kind = df.schema[c].dataType
        medians = quantiles(df, c, [0.5], by, accuracy).select(
            F.struct(*by).alias("_group"), F.col("quantiles")[0].cast(kind).alias("_median")  # a struct key matches on NULL
        )
        out = (
            out.withColumn("_group", F.struct(*by)).join(medians, "_group", "left")
            .withColumn(c, F.coalesce(F.col(c), F.col("_median")))
            .drop("_median", "_group")
        )
    return out.select(*df.columns)


def drop_incomplete(df: DataFrame, min_ratio: float = 0.5) -> DataFrame:
    """M5. Keep rows with at least `min_ratio` of their columns present."""
    return df.dropna(thresh=int(len(df.columns) * min_ratio))


def drop_missing_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """M6."""
    return df.dropna(subset=list(keys))
