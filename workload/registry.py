"""Query registration and access to tables and derived views."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from siltstone.sources.files import spread_scan
from workload import views

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """Tables of one folder as attributes (`t.orders`), derived views too (`t.dirty_orders`)."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self._seen: dict[str, DataFrame] = {}
        self._mark = uuid.uuid4().hex[:8]
        spark.conf.set("spark.sql.session.timeZone", "UTC")  # results are compared as UTC

    def __getattr__(self, name: str) -> DataFrame:
        if name in self._seen:
            return self._seen[name]
        if name in TABLES:
            found = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        elif name in views.VIEWS:
            found = self.sql(views.VIEWS[name])
        else:
            raise AttributeError(name)
        self._seen[name] = found
        return found

    def sql(self, statement: str) -> DataFrame:
        """A statement over the base tables, analysed now against this folder.

        Tables are named after FROM or JOIN; each becomes a view of its own name, so that no view of the caller is replaced.
        The statements are heavy on text; a table that comes in fewer splits than there are cores is spread first.
        """
        views_made = []
        for table in TABLES:
            named = rf"(?<=\bFROM ){table}\b|(?<=\bJOIN ){table}\b"
            if re.search(named, statement):
                view = f"{table}_{self._mark}"
                if view not in self._seen:
                    self._seen[view] = spread_scan(getattr(self, table), self.spark.sparkContext.defaultParallelism)
                self._seen[view].createOrReplaceTempView(view)
                views_made.append(view)
                statement = re.sub(named, view, statement)
        try:
            return self.spark.sql(statement)
        finally:
            for view in views_made:
                self.spark.catalog.dropTempView(view)

    def stream(self, name: str) -> DataFrame:
        """A base table as a file stream."""
        return (
            self.spark.readStream.schema(getattr(self, name).schema)
            .option("pathGlobFilter", f"{name}.parquet").parquet(self.folder)
        )


def query(name: str, oracle: str | None = None, uses: tuple[str, ...] = ()):
    """Register a query; `uses` names the derived views its oracle statement reads."""

    def register(build: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, folder: build(Tables(spark, folder))
        if oracle is not None:
            ctes = [f"{v} AS ({views.VIEWS[v]})" for v in uses]
            body = oracle.strip()
            if ctes and body.upper().startswith("WITH "):
                body = "WITH " + ", ".join(ctes) + ", " + body[5:]
            elif ctes:
                body = "WITH " + ", ".join(ctes) + " " + body
            ORACLES[name] = body
        return build

    return register
