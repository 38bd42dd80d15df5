"""Outlier bounds, removal, capping and comparison."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from quayside.functions.numbers import skewness
from quayside.operators.quantiles import quantiles


def iqr_bounds(df: DataFrame, columns: Sequence[str], width: float = 1.5) -> dict[str, tuple[float, float]]:
    """column -> (lower, upper); columns without values are left out."""
    bounds = {}
    for c, (q1, q3) in quantiles(df, columns, [0.25, 0.75]).items():
        if q1 is not None:
            bounds[c] = (q1 - width * (q3 - q1), q3 + width * (q3 - q1))
    return bounds


def outside(column: str, bounds: tuple[float, float]) -> Column:
    return (F.col(column) < bounds[0]) | (F.col(column) > bounds[1])


def iqr_outliers(df: DataFrame, column: str, width: float = 1.5) -> DataFrame:
    """The outlier rows with the bounds beside them; none in a column without values."""
    lo, hi = iqr_bounds(df, [column], width).get(column, (None, None))
    bounds = {n: F.lit(v).cast("double") for n, v in (("lower_bound", lo), ("upper_bound", hi))}
    hit = F.lit(False) if lo is None else outside(column, (lo, hi))
    return df.filter(hit).withColumns(bounds)


def zscore_outliers(df: DataFrame, column: str, threshold: float = 3.0) -> DataFrame:
    """Rows more than `threshold` population deviations off the mean."""
    x = F.col(column).cast("double")
    mean, std = df.agg(F.avg(x), F.stddev_pop(x)).first()
    z = F.try_divide(F.abs(x - F.lit(mean)), F.lit(std).cast("double"))
    return df.withColumn("z_score", z).filter(F.col("z_score") > threshold)


def remove_outliers(df: DataFrame, column: str, bounds: tuple[float, float] | None) -> DataFrame:
    """Rows within the bounds, so none without a value; `None` are the bounds of a column without values."""
    return df.filter(F.lit(False) if bounds is None else F.col(column).between(*bounds))


def capped(column: str, bounds: tuple[float, float]) -> Column:
    """Null stays null: LEAST and GREATEST alone would skip it."""
    x = F.col(column).cast("double")
    return F.when(x.isNotNull(), F.least(F.greatest(x, F.lit(bounds[0])), F.lit(bounds[1])))


def cap_outliers(df: DataFrame, bounds: dict[str, tuple[float, float]], suffix: str = "") -> DataFrame:
    return df.withColumns({f"{c}{suffix}": capped(c, b) for c, b in bounds.items()})


def moments(name: str, x: Column) -> list[Column]:
    return [
        F.count(x).alias(f"count__{name}"),
        F.avg(x).alias(f"mean__{name}"),
        F.stddev_samp(x).alias(f"std__{name}"),
        F.min(x).alias(f"min__{name}"),
        F.max(x).alias(f"max__{name}"),
        skewness(x).alias(f"skew__{name}"),
    ]


def moments_table(df: DataFrame, methods: dict[str, Column]) -> DataFrame:
    """method, count, mean, std, min, max, skew of several columns from one pass."""
    keyed = {f"m{i}": (name, x) for i, (name, x) in enumerate(methods.items())}
    row = df.agg(*[a for k, (_, x) in keyed.items() for a in moments(k, x)])
    fields = ("count", "mean", "std", "min", "max", "skew")
    items = F.array(*[
        F.struct(F.lit(name).alias("method"), *[F.col(f"{f}__{k}").alias(f) for f in fields])
        for k, (name, _) in keyed.items()
    ])
    return row.select(F.inline(items))


def compare_strategies(df: DataFrame, column: str, width: float = 1.5) -> DataFrame:
    """Moments of the column as it is, without outliers, capped, and logged; all null in a column without values."""
    x = F.col(column).cast("double")
    bounds = iqr_bounds(df, [column], width).get(column)
    return moments_table(df, {
        "Original": x,
        "Removed": F.when(x.between(*bounds), x) if bounds else x,
        "Capped": capped(column, bounds) if bounds else x,
        "Log Transformed": F.log1p(x),
    })
