"""Filling and dropping missing values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from quayside.functions.exact import number
from quayside.operators.profile import modes, null_counts
from quayside.operators.quantiles import quantiles


def learn_fill(df: DataFrame, strategies: dict[str, str], unknown: str = "Unknown") -> dict:
    """column -> fill value. Strategies: mean, median, mode, zero, or 'const:<text>'.

    Means share one pass, medians another, modes a third; only one value per column comes back.
    """
    values: dict = {}
    means = [c for c, s in strategies.items() if s == "mean"]
    medians = [c for c, s in strategies.items() if s == "median"]
    if means:
        row = df.agg(*[F.avg(number(df, c)).cast("double").alias(c) for c in means]).first()
        values |= {c: row[c] for c in means}
    if medians:
        values |= {c: v[0] for c, v in quantiles(df, medians, [0.5]).items()}
    wanted = [c for c, s in strategies.items() if s == "mode"]
    found, types = modes(df, wanted), dict(df.dtypes)
    values |= {c: unknown if v is None and types[c] == "string" else v for c, v in found.items()}
    for c, s in strategies.items():
        if s == "mode":
            continue
        if s == "zero":
            values[c] = 0
        elif s.startswith("const:"):
            values[c] = s.removeprefix("const:")
        elif s not in ("mean", "median"):
            raise ValueError(f"unknown fill strategy {s}")
    return {c: values[c] for c in strategies}


def fill(df: DataFrame, values: dict, suffix: str = "") -> DataFrame:
    """Replace nulls; an empty string is a value. `suffix` keeps the original column."""
    types = dict(df.dtypes)
    return df.withColumns({
        f"{c}{suffix}": F.coalesce(
            F.col(c), F.lit(v).cast("string" if types[c] == "string" else "double")
        )
        for c, v in values.items() if v is not None
    })


def drop_rows(df: DataFrame, how: str = "any", subset: Sequence[str] | None = None) -> DataFrame:
    return df.dropna(how=how, subset=list(subset) if subset else None)


def drop_sparse_columns(df: DataFrame, min_share: float = 0.5) -> DataFrame:
    """Drop columns with fewer than `min_share` of their rows filled; one null-count pass."""
    row = df.agg(F.count(F.lit(1)).alias("_rows"), *null_counts(df)).first()
    keep = [c for c in df.columns if row["_rows"] - row[c] >= row["_rows"] * min_share]
    return df.select(*keep)
