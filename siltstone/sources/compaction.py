"""Landing files packed into fewer, larger ones (S3).

A streaming sink's log names the landing files, so they stay as they are. A versioned table beside them holds their records in files of a
given size for each topic and day; its manifest says up to which offset of each topic partition records were taken over, and how
many landing files of each folder were looked at. Readers take the packed records, and from the landing files only the
records behind those offsets: each record comes from one of the two. Folders without a new file aren't opened again.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterable
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone import schemas
from siltstone.sources.files import read_or_empty
from siltstone.sources.versions import VersionedTable

TARGET_BYTES = 256 << 20
_BY = ("_source_topic", "ingest_date", "_run")
#: A landing file below the landing folder.
_NAME = r"(_source_topic=[^/]*/ingest_date=[^/]*/[^/]*)$"


def pack(sizes: Iterable[tuple[str, str, int]], target: int = TARGET_BYTES) -> dict[str, int]:
    """A bin for each of (folder, name, bytes): first-fit decreasing. A bin holds names of one folder, of `target` bytes at most or one larger name alone."""
    filled: list[int] = []
    open_bins: dict[str, list[int]] = defaultdict(list)
    found = {}
    for folder, name, size in sorted(sizes, key=lambda x: (x[0], -x[2], x[1])):
        place = next((b for b in open_bins[folder] if filled[b] + size <= target), None)
        if place is None:
            place = len(filled)
            filled.append(0)
            open_bins[folder].append(place)
        filled[place] += size
        if filled[place] >= target:
            open_bins[folder].remove(place)
        found[name] = place
    return found


def _name(file: str) -> str:
    return re.search(_NAME, file)[1]


def _folder(name: str) -> str:
    return name.rsplit("/", 1)[0]


def _part_folder(at: dict[str, Any]) -> str:
    return f"_source_topic={at['_source_topic']}/ingest_date={at['ingest_date']}"


def _changed(spark: SparkSession, landing: str, seen: dict[str, int]) -> tuple[dict[str, int], list[str]]:
    """How many files each folder has, and the files of folders that have more than were seen."""
    files = read_or_empty(spark, landing, schemas.BRONZE).inputFiles()
    counts = Counter(_folder(_name(f)) for f in files)
    return dict(counts), [f for f in files if counts[_folder(_name(f))] != seen.get(_folder(_name(f)), 0)]


def _records(spark: SparkSession, landing: str, files: list[str], through: list[list]) -> DataFrame:
    """The records of some landing files, with the name of their file and whether they are behind the offsets taken over."""
    rows = spark.read.schema(schemas.BRONZE).option("basePath", landing).parquet(*files)
    rows = rows.select(*rows.columns, F.regexp_extract("_metadata.file_path", _NAME, 1).alias("_name"))
    taken = spark.createDataFrame(through, "_source_topic string, _kafka_partition int, _through bigint")
    rows = rows.join(taken, ["_source_topic", "_kafka_partition"], "left")
    behind = F.col("_kafka_offset") > F.coalesce("_through", F.lit(-1))
    return rows.withColumn("_new", F.when(F.col("_kafka_partition").isNotNull(), behind)).drop("_through")


def compact(spark: SparkSession, landing: str, packed: str, target: int = TARGET_BYTES) -> int | None:
    """Takes over what has landed since the last time; the new version of the table at `packed`, or None if nothing has.

    Files with new records, and earlier runs of their topic and day that are smaller than `target`, are packed into bins of about `target`
    bytes; each bin is written as one file. Landing may go on meanwhile: what lands later has higher offsets and is left for the
    next time. A record without an offset can't be told from its copies, and fails the run. A run that dies changes nothing.
    """
    table = VersionedTable(spark, packed)
    manifest = table.manifest()
    held, about = (manifest["parts"], manifest["about"]) if manifest else ([], {"through": [], "files": {}})
    counts, files = _changed(spark, landing, about["files"])
    if not files:
        return None
    rows = _records(spark, landing, files, about["through"])
    stats = rows.groupBy("_name").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("_new").alias("fresh"), F.count_if(F.col("_new").isNull()).alias("without")).collect()
    if any(r["without"] for r in stats):
        raise ValueError(f"records without an offset in {landing}")
    share = {r["_name"]: r["fresh"] / r["n"] for r in stats if r["fresh"]}
    if not share:
        return None
    reached = rows.groupBy("_source_topic", "_kafka_partition").agg(F.max("_kafka_offset").alias("through")).collect()
    through = {(t, p): o for t, p, o in about["through"]}
    for r in reached:
        key = r["_source_topic"], r["_kafka_partition"]
        through[key] = max(r["through"], through.get(key, -1))

    folders = {_folder(name) for name in share}
    sizes = {_name(r["path"]): r["length"] for r in spark.read.format("binaryFile").load(
        [f"{landing}/{f}" for f in sorted(folders)]).select("path", "length").collect()}
    again = [p for p in held if _part_folder(p["at"]) in folders and p["bytes"] < target]
    merged = {tuple(p["at"][c] for c in _BY) for p in again}
    run_name = F.concat(F.lit("run "), "_run", F.lit(" "), "_source_topic", F.lit(" "), "ingest_date")
    bins = pack(
        [(_folder(n), n, int(sizes[n] * s)) for n, s in share.items()]
        + [(_part_folder(p["at"]), f"run {p['at']['_run']} {p['at']['_source_topic']} {p['at']['ingest_date']}", p["bytes"]) for p in again], target)
    run = 1 + max((p["at"]["_run"] for p in held), default=0)
    fresh = rows.filter("_new").drop("_new")
    if merged:
        old = table.read(only=lambda at: tuple(at[c] for c in _BY) in merged)
        fresh = fresh.unionByName(old.withColumn("_name", run_name).drop("_run"))
    placed = fresh.join(spark.createDataFrame(list(bins.items()), "_name string, _bin int"), "_name").repartitionById(
        max(bins.values()) + 1, F.col("_bin")).drop("_name", "_bin").withColumn("_run", F.lit(run))
    return table.replace(
        placed, _BY, gone=lambda at: at["_run"] == run or tuple(at[c] for c in _BY) in merged, rebalance=False,
        about={"through": [[*key, offset] for key, offset in sorted(through.items())], "files": counts})


def read_packed(spark: SparkSession, landing: str, packed: str, since: str | None = None) -> DataFrame:
    """All landing records, from `since` (a day) on if it is given: packed ones, and from landing files those not taken over yet."""
    table = VersionedTable(spark, packed)
    manifest = table.manifest()
    later = F.col("ingest_date") >= F.lit(since).cast("date") if since else F.lit(True)
    if manifest is None:
        return read_or_empty(spark, landing, schemas.BRONZE).filter(later)
    rows = table.read(only=lambda at: not since or (at["ingest_date"] or "") >= since, version=manifest["version"]).drop("_run")
    _, files = _changed(spark, landing, manifest["about"]["files"])
    if files:
        rows = rows.unionByName(_records(spark, landing, files, manifest["about"]["through"]).filter(F.col("_new") & later).drop("_new", "_name"))
    return rows.select(*read_or_empty(spark, landing, schemas.BRONZE).columns)
