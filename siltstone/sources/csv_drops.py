"""Warehouse CSV drops."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from siltstone import schemas

LIFECYCLE_FILES = "products_bootstrap_*.csv"
STOCK_FILES = "products_stock_update_*.csv"


def read_csv_drops(
    spark: SparkSession, folder: str, *, lifecycle: str = LIFECYCLE_FILES, stock: str = STOCK_FILES,
) -> DataFrame:
    """S15. One stream over both file layouts of a drop folder, told apart by file name."""

    def layout(schema: str, glob: str) -> DataFrame:
        return (
            spark.readStream.schema(schema).option("header", True).option("escape", '"')
            .option("multiLine", True).option("pathGlobFilter", glob).csv(folder)
        )

    return layout(schemas.WAREHOUSE_LIFECYCLE, lifecycle).unionByName(
        layout(schemas.WAREHOUSE_STOCK, stock), allowMissingColumns=True
    )
