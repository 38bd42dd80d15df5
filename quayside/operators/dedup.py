"""Duplicates: keep one, keep none, list, profile.

Copies are combined before the shuffle (MIN / MAX / COUNT per key), so a group
of copies that holds much of the table never meets in one task.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from quayside.operators.profile import distinct_rows, row_key


def _keyed(df: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
    return df.withColumn("_key", row_key(df, keys))


def keep_one(df: DataFrame, keys: Sequence[str | Column], order: str, keep: str = "first") -> DataFrame:
    """One row per key: `first` or `last` by the unique column `order`, or `none` of the repeated.

    The surviving ids are found on (key, id) alone; the wide rows are then
    picked by a semi join on the unique id, which has no skew.
    """
    groups = _keyed(df, keys).groupBy("_key")
    if keep == "none":
        ids = groups.agg(F.min(order).alias("_id"), F.count(F.lit(1)).alias("_n"))
        ids = ids.filter(F.col("_n") == 1)
    elif keep in ("first", "last"):
        ids = groups.agg((F.min if keep == "first" else F.max)(order).alias("_id"))
    else:
        raise ValueError("keep is first, last or none")
    return df.join(ids.select("_id"), F.col(order) == F.col("_id"), "left_semi")


def distinct_by(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One whole row per key for tables without a unique column: the smallest by `order`."""
    rest = [c for c in df.columns if c not in keys]
    best = F.min_by(F.struct(*rest), F.struct(*order)).alias("_row")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col(f"_row.{c}") for c in rest]).select(*df.columns)


def repeated(df: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
    """All members of groups with more than one row."""
    marked = _keyed(df, keys)
    many = marked.groupBy("_key").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1)
    return marked.join(many, "_key", "left_semi").drop("_key")


def name_variants(df: DataFrame, key: str, name: str) -> DataFrame:
    """Rows of keys that carry more than one trimmed, lower-case name."""
    pairs = df.select(key, F.lower(F.trim(F.col(name))).alias("_name")).distinct()
    many = pairs.groupBy(key).agg(F.count("_name").alias("_n")).filter(F.col("_n") > 1)
    return df.join(many.select(key), key, "left_semi")


def duplicate_profile(df: DataFrame, subsets: dict[str, Sequence[str] | None]) -> DataFrame:
    """Rows beyond the first of their group, per named set of columns (None: all)."""
    parts = [
        distinct_rows(df, cols).select(
            F.lit(name).alias("kind"), (F.col("rows") - F.col("groups")).alias("duplicates")
        )
        for name, cols in subsets.items()
    ]
    return reduce(DataFrame.unionByName, parts)
