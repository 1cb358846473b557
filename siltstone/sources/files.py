"""File readers."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

CORRUPT = "_corrupt_record"


def read_or_empty(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """S5. Parquet at `path`, or no rows of the declared schema when nothing was written yet.

    Only a missing path counts as empty; every other failure is raised.
    """
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise


def read_csv(spark: SparkSession, path: str, schema: str, *, multiline: bool = True, null: str = "") -> DataFrame:
    """S9. CSV with a header and a declared schema; a row that does not fit keeps its text.

    Quoted line breaks need `multiline`, which reads each file in one task: keep files moderate, or
    switch it off for files known to have none, so that they split.

    A field that reads `null` is NULL: by default an empty one. With another spelling, empty and blank text stays what it is.

    A row is judged by all declared columns, whichever of them the query goes on to use: Spark
    converts only the columns a plan reads, so the corrupt-row column is tied to every one of them.
    """
    rows = (
        spark.read.schema(f"{schema}, {CORRUPT} string")
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("multiLine", multiline)
        .option("escape", '"')
        .option("nullValue", null)
        .csv(path)
    )
    everything = F.concat_ws("", *[F.col(c).cast("string") for c in rows.columns if c != CORRUPT])
    return rows.withColumn(CORRUPT, F.when(F.length(everything) >= 0, F.col(CORRUPT)))


def split_corrupt(df: DataFrame, column: str = CORRUPT) -> tuple[DataFrame, DataFrame]:
    """S10. (rows that fitted, rows that did not)."""
    return df.filter(F.col(column).isNull()).drop(column), df.filter(F.col(column).isNotNull())


def read_json_array(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """S11. Files holding one JSON array of objects. Columns of mixed types read as text."""
    reader = spark.read.option("multiLine", True)
    return (reader.schema(schema) if schema else reader).json(path)


def spread_scan(df: DataFrame, slots: int) -> DataFrame:
    """Spread a scan that has fewer than `slots` splits over that many tasks.

    For files that do not split (one row group, gzip, multi-line text). A scan with enough splits
    is returned as it is, so large tables are not shuffled. Give it a scan with at most narrow
    transformations.
    """
    splits = df._jdf.queryExecution().toRdd().getNumPartitions()
    return df.repartition(slots) if 0 < splits < slots else df
