"""Lazy access to the parquet tables of one folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLE_NAMES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


class Tables:
    """`Tables(spark, folder).orders` is the scan of `folder/orders.parquet`."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLE_NAMES:
            raise AttributeError(name)
        return self.spark.read.parquet(self.path(name))

    def register(self, *names: str) -> None:
        """Expose tables to `spark.sql` as temporary views."""
        for name in names:
            getattr(self, name).createOrReplaceTempView(name)
