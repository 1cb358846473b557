"""Parquet tables in versions: each is a manifest of folders, and one rename makes it the table.

Below the table's path, `data/` holds one folder for each write and is only ever added to; `_versions/<n>.json` names the
folders that make up version n, with the rows, files, bytes and an order-free checksum of each. A write that dies leaves folders that no
manifest names; readers go on with the version they have resolved. Of two writers that start from the same version, one fails.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable, Sequence
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

Part = dict[str, Any]
_WRITE = "_write"
_NULL = "__HIVE_DEFAULT_PARTITION__"


class ConcurrentWrite(RuntimeError):
    """Another writer has made the version that this one was about to make."""


def checksum(columns: Sequence[str]) -> Column:
    """Sum of the rows' hashes: equal rows in another order give the same, a lost or doubled one doesn't."""
    return F.coalesce(F.sum(F.xxhash64(*columns).cast("decimal(20,0)")), F.lit(0)).cast("string")


class VersionedTable:
    """A table at `path`. Manifests are read anew for each call."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _at(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")

    def _files(self):
        return self._at("data").getFileSystem(self.spark._jsc.hadoopConfiguration())

    def versions(self) -> list[int]:
        files, folder = self._files(), self._at("_versions")
        if not files.exists(folder):
            return []
        names = (str(status.getPath().getName()) for status in files.listStatus(folder))
        return sorted(int(found[1]) for name in names if (found := re.fullmatch(r"(\d+)\.json", name)))

    def manifest(self, version: int | None = None) -> dict[str, Any] | None:
        """What a version is made of, by default the newest; None if there is none."""
        if version is None:
            known = self.versions()
            if not known:
                return None
            version = known[-1]
        stream = self._files().open(self._at(f"_versions/{version}.json"))
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _commit(self, manifest: dict[str, Any]) -> int:
        files, jvm = self._files(), self.spark._jvm.org.apache.hadoop.fs
        beside, place = self._at(f"_versions/.{uuid.uuid4().hex}"), self._at(f"_versions/{manifest['version']}.json")
        stream = files.create(beside, False)
        stream.write(bytearray(json.dumps(manifest).encode()))
        stream.close()
        how = self.spark.sparkContext._gateway.new_array(getattr(jvm, "Options$Rename"), 0)
        context = jvm.FileContext.getFileContext(files.getUri(), self.spark._jsc.hadoopConfiguration())
        try:
            context.rename(files.makeQualified(beside), files.makeQualified(place), how)
        except Py4JJavaError as problem:
            if "FileAlreadyExists" not in problem.java_exception.getClass().getName():
                raise
            files.delete(beside, False)
            raise ConcurrentWrite(f"version {manifest['version']} of {self.path} is there already") from problem
        return manifest["version"]

    def _written(self, df: DataFrame, part_by: Sequence[str], sub_by: Sequence[str], rebalance: bool) -> list[Part]:
        """Writes a folder of its own, and reads back what each part of it holds."""
        by, write = [*part_by, *sub_by], f"{_WRITE}={uuid.uuid4().hex}"
        shaped = df.hint("rebalance", *[F.col(c) for c in by]) if by and rebalance else df
        shaped.write.partitionBy(*by).parquet(f"{self.path}/data/{write}")
        back = self.spark.read.schema(df.schema).parquet(f"{self.path}/data/{write}")
        back = back.select(*df.columns, F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_size").alias("_size"))
        files = back.groupBy(*part_by, "_file").agg(
            F.count(F.lit(1)).alias("_rows"), checksum(df.columns).alias("_checksum"), F.max("_size").alias("_size")).collect()
        found: dict[str, Part] = {}
        for row in files:
            at = {c: None if row[c] is None else row[c] if isinstance(row[c], int) else str(row[c]) for c in part_by}
            folder = "/".join([write, *[f"{c}={_NULL if v is None else v}" for c, v in at.items()]])
            part = found.setdefault(folder, {"at": at, "folder": folder, "rows": 0, "checksum": 0, "files": 0, "bytes": 0})
            for name, more in (("rows", row["_rows"]), ("checksum", int(row["_checksum"])), ("files", 1), ("bytes", row["_size"])):
                part[name] += more
        return [{**part, "checksum": str(part["checksum"])} for part in found.values()]

    def replace(
        self, df: DataFrame, part_by: Sequence[str] = (), sub_by: Sequence[str] = (),
        gone: Callable[[dict[str, Any]], bool] = lambda at: True, about: dict[str, Any] | None = None, rebalance: bool = True,
    ) -> int:
        """A new version: the parts that `gone` holds for are replaced by the rows of `df`, the others stay as they are.

        A part is a combination of the values in `part_by`: integers, dates, or names made of letters, digits, `.`, `_` and `-`; `sub_by` are partition columns below it. All rows of `df` must
        belong to parts that are replaced. `about` is kept in the manifest. `df` may read this table. Rows are evened out over the partition
        columns before they are written, unless `rebalance` is false: then each task's rows of a partition become a file.
        """
        before = self.manifest()
        kept = [p for p in before["parts"] if not gone(p["at"])] if before else []
        if kept and (before["part_by"] != list(part_by) or StructType.fromJson(before["schema"]).simpleString() != df.schema.simpleString()):
            raise ValueError("parts that stay have other columns; replace them all")
        parts = self._written(df, part_by, sub_by, rebalance)
        if odd := [p["at"] for p in parts if not gone(p["at"])]:
            raise ValueError(f"rows outside the replaced parts: {odd[:3]}")
        return self._commit({
            "version": before["version"] + 1 if before else 1, "schema": df.schema.jsonValue(), "part_by": list(part_by),
            "about": about or {}, "parts": sorted(kept + parts, key=lambda p: json.dumps(p["at"]))})

    def overwrite(self, df: DataFrame, partition_by: Sequence[str] = ()) -> int:
        """S6. A full rebuild as a new version."""
        return self.replace(df, (), partition_by)

    def read(
        self, schema: str | StructType | None = None, only: Callable[[dict[str, Any]], bool] | None = None, version: int | None = None,
    ) -> DataFrame:
        """The rows of a version, by default the newest; with `only` just the parts that it holds for are listed and read.

        A table without a version has no rows; `schema` says of which columns.
        """
        manifest = self.manifest(version)
        if manifest is None:
            if schema is None:
                raise ValueError(f"no table at {self.path}, and no schema given")
            return self.spark.createDataFrame([], schema)
        shape = StructType.fromJson(manifest["schema"])
        folders = [f"{self.path}/data/{p['folder']}" for p in manifest["parts"] if only is None or only(p["at"])]
        if not folders:
            return self.spark.createDataFrame([], shape)
        rows = self.spark.read.schema(StructType([*shape.fields]).add(_WRITE, "string")).option("basePath", f"{self.path}/data").parquet(*folders)
        return rows.select(*shape.names)

    def verify(self, version: int | None = None) -> DataFrame:
        """(folder, rows, found_rows) of the parts whose files no longer hold what was written: rows are counted and summed anew."""
        manifest = self.manifest(version)
        parts, shape = manifest["parts"], StructType.fromJson(manifest["schema"])
        stated = self.spark.createDataFrame(
            [(p["folder"], p["rows"], p["checksum"]) for p in parts], "folder string, rows bigint, checksum string")
        if not parts:
            return stated.select("folder", "rows", F.lit(0).cast("bigint").alias("found_rows"))
        depth = len(manifest["part_by"])
        folder = F.regexp_extract("_metadata.file_path", rf"/data/({_WRITE}=[^/]+(?:/[^/]+){{{depth}}})/", 1)
        rows = self.spark.read.schema(StructType([*shape.fields]).add(_WRITE, "string")).option("basePath", f"{self.path}/data").parquet(
            *[f"{self.path}/data/{p['folder']}" for p in parts])
        found = rows.withColumn("folder", folder).groupBy("folder").agg(
            F.count(F.lit(1)).alias("found_rows"), checksum(shape.names).alias("found_checksum"))
        same = F.col("rows").eqNullSafe(F.col("found_rows")) & F.col("checksum").eqNullSafe(F.col("found_checksum"))
        return stated.join(found, "folder", "left").filter(~same).select(
            "folder", "rows", F.coalesce("found_rows", F.lit(0)).alias("found_rows"))

    def vacuum(self, keep: int = 2) -> int:
        """Deletes all but the newest `keep` versions and the writes that none of these names; returns how many writes went.

        Not for a time when someone writes: a write that isn't committed yet would go too.
        """
        if keep < 1:
            raise ValueError("the newest version must stay")
        files, known = self._files(), self.versions()
        used = {p["folder"].split("/")[0] for v in known[-keep:] for p in self.manifest(v)["parts"]}
        for v in known[:-keep]:
            files.delete(self._at(f"_versions/{v}.json"), False)
        gone = 0
        if files.exists(self._at("data")):
            for status in files.listStatus(self._at("data")):
                if str(status.getPath().getName()) not in used:
                    gone += bool(files.delete(status.getPath(), True))
        return gone
