"""Session settings the engine is written for, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join side even where the split costs one more exchange.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.parquet.filterPushdown": "true",
    # Folders say which partitions a table has, so that a table moves to new files by its location alone.
    "spark.sql.hive.manageFilesourcePartitions": "false",
    # Stream state larger than the heap lives on local disk, its changes in the checkpoint.
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(app_name: str = "siltstone", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the engine's settings. Shuffle width is left to the cluster and to AQE."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


#: Temporary folders of local sessions that name none, by application.
_LOCAL: dict[str, str] = {}
#: The folder of the run that is under way, if there is one.
_WORKING: ContextVar[str | None] = ContextVar("working", default=None)


def scratch_folder(spark: SparkSession, label: str) -> str:
    """A fresh path for intermediate tables, under the folder the cluster shares.

    `spark.checkpoint.dir` names that folder. Only a local-mode session without the setting falls
    back to a temporary folder; on a cluster the setting is required, because executors cannot see
    the driver's disk.
    """
    root = _WORKING.get() or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        app = spark.sparkContext.applicationId
        root = _LOCAL[app] = _LOCAL.get(app) or tempfile.mkdtemp(prefix="siltstone-")
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def kept(df: DataFrame, label: str) -> DataFrame:
    """The rows written to a scratch folder and read back, so that lineage ends here."""
    path = scratch_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Deletes a folder, wherever it is, with all that is in it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def working_folder(spark: SparkSession) -> Iterator[str]:
    """Scratch folders asked for inside lie in one of their own, which goes when the block ends.

    What is to outlive the block must be written to a folder that was asked for before; frames that read scratch folders don't.
    """
    root = scratch_folder(spark, "work")
    held = _WORKING.set(root)
    try:
        yield root
    finally:
        _WORKING.reset(held)
        remove_folder(spark, root)
