"""Feature scaling: learn the figures in one pass, apply them as literals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from quayside.operators.outliers import moments_table
from quayside.operators.quantiles import quantiles


METHODS = ("standard", "minmax", "robust")


def learn_scalings(df: DataFrame, columns: Sequence[str], methods: Sequence[str]) -> dict[str, dict[str, tuple[float, float]]]:
    """method -> column -> (centre, width), from one pass and that of the quantiles.

    A constant column gets width 1, so it scales to 0; columns without values are left out.
    """
    for m in methods:
        if m not in METHODS:
            raise ValueError(f"unknown scaling {m}")
    aggs = []
    for k, c in enumerate(columns):
        x = F.col(c).cast("double")
        if "standard" in methods:
            aggs += [F.avg(x).alias(f"standard_a{k}"), F.stddev_pop(x).alias(f"standard_b{k}")]
        if "minmax" in methods:
            aggs += [F.min(x).alias(f"minmax_a{k}"), (F.max(x) - F.min(x)).alias(f"minmax_b{k}")]
    row = df.agg(*aggs).first() if aggs else {}
    found = {m: {c: (row[f"{m}_a{k}"], row[f"{m}_b{k}"]) for k, c in enumerate(columns)} for m in methods if m != "robust"}
    if "robust" in methods:
        found["robust"] = {
            c: (q2, None if q1 is None else q3 - q1) for c, (q1, q2, q3) in quantiles(df, columns, [0.25, 0.5, 0.75]).items()
        }
    return {m: {c: (a, b or 1.0) for c, (a, b) in found[m].items() if a is not None} for m in methods}


def learn_scaling(df: DataFrame, columns: Sequence[str], method: str) -> dict[str, tuple[float, float]]:
    """column -> (centre, width) of one method."""
    return learn_scalings(df, columns, [method])[method]


def scaled(column: str, figures: tuple[float, float]) -> Column:
    return (F.col(column).cast("double") - F.lit(figures[0])) / F.lit(figures[1])


def scale(df: DataFrame, columns: Sequence[str], method: str, suffix: str = "") -> DataFrame:
    figures = learn_scaling(df, columns, method)
    return df.withColumns({f"{c}{suffix}": scaled(c, figures[c]) for c in columns if c in figures})


def compare_scalings(df: DataFrame, column: str) -> DataFrame:
    """min, max, mean and std of the column and its three scalings, learned together, from one pass; all null without values."""
    x, learned = F.col(column).cast("double"), learn_scalings(df, [column], METHODS)
    methods = {"Original": x}
    for name, method in zip(("Standardized", "Normalized", "Robust"), METHODS):
        methods[name] = scaled(column, learned[method][column]) if column in learned[method] else x
    return moments_table(df, methods).select("method", "min", "max", "mean", "std")
