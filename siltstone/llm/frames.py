"""Intermediate tables in the folder that the cluster shares, and rows told apart by their values."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType, _parse_datatype_string

from siltstone.session import scratch_folder

SLICE_BYTES = 8 << 20
FILES_PER_CORE = 3
#: Settings of a step's write.
_STEP = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
}


def stored(frame: DataFrame, label: str, small: bool = False, path: str | None = None) -> DataFrame:
    """The rows written to the shared folder and read back: lineage ends here, and an executor
    that is lost later takes nothing with it. The shuffle files behind them are then of no use, and go.

    Nothing is broadcast unless it is marked so: the sides of a join in such a step grow with the corpus, and the size of a
    compressed file says little of what it holds (38 MB were sent for 256 kB).

    With `path` they are written there, else to a new scratch folder. A `small` table, of counts or links, gets a few files for each core at most, in however many partitions it came.
    """
    spark = frame.sparkSession
    path = path or scratch_folder(spark, label)
    if small:
        frame = frame.coalesce(FILES_PER_CORE * spark.sparkContext.defaultParallelism)
    before = {key: spark.conf.get(key, None) for key in _STEP}
    for key, value in _STEP.items():
        spark.conf.set(key, value)
    try:
        frame.select("*").write.parquet(path)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    return spark.read.schema(frame.schema).parquet(path)


def typed(**fields: str | DataType) -> StructType:
    """A schema of fields given by their type or its name."""
    return StructType([
        StructField(n, k if isinstance(k, DataType) else _parse_datatype_string(k)) for n, k in fields.items()])


def row_print(text: Column) -> Column:
    """64 bits of a text; with the id it tells rows apart that share an id."""
    return F.xxhash64(F.coalesce(text, F.lit("")), text.isNull())


def slices(batch: pa.RecordBatch, limit: int = SLICE_BYTES, field: str | None = None) -> Iterator[pa.RecordBatch]:
    """A batch in runs of rows of about `limit` bytes of text (one row at least).

    The text is the first column, or a field of it. Rows are copied out: a cast of a sliced array of strings can go wrong.
    """
    texts = batch.column(0) if field is None else batch.column(0).field(field)
    if texts.nbytes <= limit:
        if batch.num_rows:
            yield batch
        return
    start = held = 0
    for i in range(batch.num_rows):
        size = texts[i].as_buffer().size if texts[i].is_valid else 0
        if i > start and held + size > limit:
            yield batch.take(pa.array(range(start, i)))
            start, held = i, 0
        held += size
    yield batch.take(pa.array(range(start, batch.num_rows)))
