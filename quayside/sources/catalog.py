"""Catalog tables, SQL with parameters, JDBC, saved and refreshed results."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, types as T

WRITE_MODES = {"replace": "overwrite", "append": "append", "fail": "errorifexists"}


def read_table(spark: SparkSession, name: str, limit: int | None = None) -> DataFrame:
    df = spark.table(name)
    return df if limit is None else df.limit(limit)


def write_table(df: DataFrame, name: str, if_exists: str = "fail", partition_by: Sequence[str] = ()) -> None:
    """Partitioned writes are rebalanced first: small partitions share a file's
    worth of task, large ones are split over several tasks."""
    if if_exists not in WRITE_MODES:
        raise ValueError(f"if_exists is one of {', '.join(WRITE_MODES)}")
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode(WRITE_MODES[if_exists]).format("parquet")
    (writer.partitionBy(*partition_by) if partition_by else writer).saveAsTable(name)


def create_table(spark: SparkSession, name: str, schema: T.StructType, partition_by: Sequence[str] = ()) -> bool:
    """False when the table is already there. Keys are not enforced; check them
    with `operators.quality`."""
    if table_exists(spark, name):
        return False
    columns = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}" for f in schema
    )
    parts = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet{parts}")
    return True


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def run_sql(spark: SparkSession, sql: str, **params) -> DataFrame:
    """SQL with `:name` markers; the values are bound, never pasted into the text."""
    return spark.sql(sql, args=params)


def read_jdbc(
    spark: SparkSession, url: str, table: str | None = None, query: str | None = None,
    partition_column: str | None = None, bounds: tuple[int, int] | None = None, partitions: int = 1,
    **options: str,
) -> DataFrame:
    """A database table or query. With a partition column the read is split over
    `partitions` tasks; credentials come from the caller's options."""
    if (table is None) == (query is None):
        raise ValueError("give either table or query")
    reader = spark.read.format("jdbc").option("url", url).options(**options)
    if partition_column:
        if bounds is None:
            raise ValueError("a partition column needs bounds")
        source = table if table else f"({query}) q"
        return reader.options(
            dbtable=source, partitionColumn=partition_column, lowerBound=bounds[0], upperBound=bounds[1],
            numPartitions=partitions,
        ).load()
    return (reader.option("dbtable", table) if table else reader.option("query", query)).load()


def write_jdbc(df: DataFrame, url: str, table: str, if_exists: str = "fail", **options: str) -> None:
    if if_exists not in WRITE_MODES:
        raise ValueError(f"if_exists is one of {', '.join(WRITE_MODES)}")
    df.write.format("jdbc").mode(WRITE_MODES[if_exists]).options(url=url, dbtable=table, **options).save()


def analyze(spark: SparkSession, name: str) -> None:
    """Row count, size and column statistics for the cost-based planner."""
    spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS FOR ALL COLUMNS")


def versions(spark: SparkSession, name: str) -> list[int]:
    """Version numbers of a saved result; the name may carry its database."""
    database, _, bare = name.rpartition(".")
    tables = spark.catalog.listTables(database) if database else spark.catalog.listTables()
    found = [re.fullmatch(rf"{re.escape(bare)}__v(\d+)", t.name) for t in tables]
    return sorted(int(m.group(1)) for m in found if m)


def publish(df: DataFrame, name: str, partition_by: Sequence[str] = (), keep: int = 2) -> int:
    """Save `df` as the next version of `name` and point the view at it.

    Readers of the view see the old version until the new one is complete, and
    a running read keeps its files: the version before stays (`keep`).
    """
    spark = df.sparkSession
    known = versions(spark, name)
    version = (known[-1] if known else 0) + 1
    write_table(df, f"{name}__v{version}", "fail", partition_by)
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {name}__v{version}")
    for old in [*known, version][:-keep]:
        spark.sql(f"DROP TABLE {name}__v{old}")
    return version
