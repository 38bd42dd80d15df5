"""Saved results that are refreshed by partition.

`publish` writes a whole new version. Here a new result is compared with the
saved one on its unique key, and only the partitions in which a row came, went
or changed are written again. The rows of all versions lie in one table,
partitioned by version and by the result's own columns; a manifest names the
version that holds each partition, and the view joins the two. Readers keep the
manifest they started on, and its files stay.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from quayside.session import materialise
from quayside.sources.catalog import table_exists

VERSION = "_version"


def _tables(spark: SparkSession, name: str, pattern: str) -> list[int]:
    database, _, bare = name.rpartition(".")
    tables = spark.catalog.listTables(database) if database else spark.catalog.listTables()
    found = [re.fullmatch(rf"{re.escape(bare)}{pattern}(\d+)", t.name) for t in tables]
    return sorted(int(m.group(1)) for m in found if m)


def refreshed_versions(spark: SparkSession, name: str) -> list[int]:
    """Version numbers whose manifest is still there."""
    return _tables(spark, name, "__m")


def manifest(spark: SparkSession, name: str) -> DataFrame:
    """The partitions of the current version, each with the version that wrote it."""
    return spark.table(f"{name}__m{refreshed_versions(spark, name)[-1]}")


def _same(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[c].eqNullSafe(right[c]) for c in columns])


def _comparable(df: DataFrame, name: str) -> Column:
    """The column, or a form of it where it holds maps, which have no equality."""
    kind = df.select(f"`{name}`").dtypes[0][1]
    if "map<" not in kind:
        return F.col(f"`{name}`")
    if kind.startswith("map<") and kind.count("map<") == 1:
        return F.array_sort(F.map_entries(f"`{name}`"))
    return F.to_json(F.struct(f"`{name}`"))


def _changed(new: DataFrame, old: DataFrame, key: Sequence[str], parts: Sequence[str]) -> DataFrame:
    """The partitions in which a key's row differs, by one aggregate over both results."""
    kept = [*parts, *[c for c in new.columns if c not in parts]]
    row = F.struct(*[_comparable(new, c).alias(c) for c in kept])
    both = old.select(*new.columns).select(*key, row.alias("_old"), F.lit(None).cast(new.select(row).dtypes[0][1]).alias("_new"))
    both = both.unionByName(new.select(*key, F.lit(None).cast(new.select(row).dtypes[0][1]).alias("_old"), row.alias("_new")))
    pairs = both.groupBy(*key).agg(F.first("_old", True).alias("_old"), F.first("_new", True).alias("_new"))
    place = lambda side: F.when(F.col(side).isNotNull(), F.struct(*[F.col(side)[c].alias(c) for c in parts]))
    unlike = pairs.where(~F.col("_old").eqNullSafe(F.col("_new")))
    found = unlike.select(F.explode(F.array(place("_old"), place("_new"))).alias("p")).where(F.col("p").isNotNull())
    return found.select("p.*").distinct()


def _drop_unused(spark: SparkSession, name: str, kept: Sequence[int], parts: Sequence[str]) -> None:
    """Drop the partitions that no kept manifest names; the list is as long as the partitions are many."""
    used = reduce(DataFrame.unionByName, [spark.table(f"{name}__m{v}").select(VERSION, *parts) for v in kept])
    used = {tuple(None if v is None else str(v) for v in r) for r in used.distinct().collect()}
    for (spec,) in spark.sql(f"SHOW PARTITIONS {name}__data").collect():
        fields = [p.split("=", 1) for p in spec.split("/")]
        values = tuple(None if v in ("__HIVE_DEFAULT_PARTITION__", "null") else unquote(v) for _, v in fields)
        if values not in used:
            text = lambda v: "null" if v is None else "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
            spark.sql(f"ALTER TABLE {name}__data DROP IF EXISTS PARTITION ({', '.join(f'`{f}` = {text(v)}' for (f, _), v in zip(fields, values))})")


def refresh(df: DataFrame, name: str, key: Sequence[str], partition_by: Sequence[str], keep: int = 2) -> int:
    """Save `df` as the next version of `name`, writing only partitions that changed; the version number.

    `key` must be unique in `df` (nulls count as equal), else nothing is
    written. A version is visible once its manifest is saved and the view
    replaced; what a failed run left behind is replaced by the next one. The
    last `keep` versions can be read to their end, older files are dropped.
    """
    spark, parts = df.sparkSession, list(partition_by)
    new = materialise(df, "refresh")
    twice = new.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(*key).first()
    if twice:
        raise ValueError(f"key {', '.join(key)} is not unique: {tuple(twice)}")
    known = refreshed_versions(spark, name)
    version = (known[-1] if known else 0) + 1
    data, last = f"{name}__data", f"{name}__m{known[-1]}" if known else None
    if last:
        changed = materialise(_changed(new, spark.table(name), key, parts), "refresh-changed")
        todo = new.join(changed, _same(new, changed, parts), "left_semi")
    else:
        todo = new
    todo = todo.withColumn(VERSION, F.lit(version))
    if not table_exists(spark, data):
        todo.limit(0).write.partitionBy(VERSION, *parts).format("parquet").saveAsTable(data)
    elif last:
        _drop_unused(spark, name, known, parts)
    columns = spark.table(data).columns
    todo.select(*columns).hint("rebalance", VERSION, *parts).write.mode("append").format("parquet").partitionBy(VERSION, *parts).saveAsTable(data)
    held = todo.select(*parts).distinct().withColumn(VERSION, F.lit(version))
    if last:
        before = spark.table(last)
        held = before.join(changed, _same(before, changed, parts), "left_anti").unionByName(held)
    # one row for each partition
    held.coalesce(1).write.format("parquet").saveAsTable(f"{name}__m{version}")
    on = " AND ".join([f"d.{VERSION} = m.{VERSION}", *(f"d.`{c}` <=> m.`{c}`" for c in parts)])
    shown = ", ".join(f"d.`{c}`" for c in new.columns)
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT {shown} FROM {data} d JOIN {name}__m{version} m ON {on}")
    for old in [*known, version][:-keep]:
        spark.sql(f"DROP TABLE {name}__m{old}")
    _drop_unused(spark, name, [*known, version][-keep:], parts)
    return version


def drop_refreshed(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP VIEW IF EXISTS {name}")
    for v in refreshed_versions(spark, name):
        spark.sql(f"DROP TABLE IF EXISTS {name}__m{v}")
    spark.sql(f"DROP TABLE IF EXISTS {name}__data")
