"""Picking columns from a schema."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F, types as T


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]


def columns_like(df: DataFrame, pattern: str) -> list[str]:
    """Columns whose name contains `pattern`, case ignored."""
    return [c for c in df.columns if re.search(pattern, c, re.IGNORECASE)]


def missing_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    return [c for c in required if c not in df.columns]


def required_columns(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """column_name, is_present and filled: how many rows have a value, null for a column that is not there.

    One pass over the required columns that are there; no other column is read.
    """
    absent = set(missing_columns(df, required))
    count = lambda c: F.lit(None).cast("long") if c in absent else F.count(F.col(f"`{c}`"))
    row = df.agg(F.count(F.lit(1)).alias("_rows"), *[count(c).alias(f"c{k}") for k, c in enumerate(required)])
    items = [F.struct(F.lit(c).alias("column_name"), F.lit(c not in absent).alias("is_present"), F.col(f"c{k}").alias("filled")) for k, c in enumerate(required)]
    return row.select(F.inline(F.array(*items)))
