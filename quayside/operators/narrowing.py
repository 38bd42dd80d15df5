"""Smallest column types that hold the data."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

# Ranges of the integer types, smallest first.
INT_RANGES = (
    ("tinyint", -(2**7), 2**7 - 1),
    ("smallint", -(2**15), 2**15 - 1),
    ("int", -(2**31), 2**31 - 1),
    ("bigint", -(2**63), 2**63 - 1),
)
LOW_CARDINALITY = 0.5


def column_ranges(df: DataFrame) -> DataFrame:
    """One row per column: type, min and max of integers, and the type they fit.

    Text columns are flagged low_cardinality under half as many values as rows
    (parquet then stores them by dictionary). One pass for the ranges; the text
    columns' exact distinct counts come from value groups, combined before the
    shuffle.
    """
    ints = [f.name for f in df.schema if isinstance(f.dataType, T.IntegralType)]
    texts = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for c in ints:
        aggs += [F.min(c).cast("bigint").alias(f"lo__{c}"), F.max(c).cast("bigint").alias(f"hi__{c}")]
    for c in texts:
        aggs.append(F.count_distinct(F.col(c)).alias(f"n__{c}"))
    row = df.agg(*aggs)
    items = []
    for f in df.schema:
        c, lo, hi, n = f.name, F.lit(None).cast("bigint"), F.lit(None).cast("bigint"), F.lit(None).cast("bigint")
        fit, low = F.lit(f.dataType.simpleString()), F.lit(None).cast("boolean")
        if c in ints:
            lo, hi = F.col(f"lo__{c}"), F.col(f"hi__{c}")
            fit = F
            for name, a, b in INT_RANGES:
                fit = fit.when((lo >= a) & (hi <= b), name)
            fit = fit.otherwise(f.dataType.simpleString())
        elif c in texts:
            n = F.col(f"n__{c}")
            low = n < F.col("_rows") * F.lit(LOW_CARDINALITY)
        elif isinstance(f.dataType, T.DoubleType):
            fit = F.lit("float")
        items.append(F.struct(
            F.lit(c).alias("column_name"), F.lit(f.dataType.simpleString()).alias("source_type"),
            lo.alias("min_value"), hi.alias("max_value"), n.alias("distinct_values"),
            fit.alias("narrow_type"), low.alias("low_cardinality"),
        ))
    return row.select(F.inline(F.array(*items)))


def narrow(df: DataFrame, floats: bool = True) -> DataFrame:
    """Cast integers to the smallest type that holds them, doubles to float."""
    ints = [f.name for f in df.schema if isinstance(f.dataType, T.IntegralType)]
    casts = {}
    if ints:
        row = df.agg(*[x for c in ints for x in (F.min(c).alias(f"a_{c}"), F.max(c).alias(f"b_{c}"))]).first()
        for c in ints:
            lo, hi = row[f"a_{c}"], row[f"b_{c}"]
            if lo is not None:
                casts[c] = next(name for name, a, b in INT_RANGES if a <= lo and hi <= b)
    if floats:
        casts |= {f.name: "float" for f in df.schema if isinstance(f.dataType, T.DoubleType)}
    return df.withColumns({c: F.col(c).cast(t) for c, t in casts.items()})
