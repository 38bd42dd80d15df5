"""Counts, moments, frequencies and quality figures of a table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from quayside.functions.exact import number
from quayside.operators.quantiles import quantiles


def _long(row: DataFrame, columns: Sequence[str], measures: Sequence[str], key: str) -> DataFrame:
    """One wide row `measure__column` -> one row per column."""
    items = F.array(*[
        F.struct(F.lit(c).alias(key), *[F.col(f"{m}__{c}").alias(m) for m in measures])
        for c in columns
    ])
    return row.select(F.inline(items))


def numeric_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, min, max, mean, std (n-1), range and exact quartiles per column.

    One pass for all but the quartiles, which have their own (see `quantiles`).
    """
    quartiles = quantiles(df, columns, [0.25, 0.5, 0.75])
    aggs = []
    for c in columns:
        x = F.col(c).cast("double")
        aggs += [
            F.count(c).alias(f"count__{c}"),
            F.min(x).alias(f"min__{c}"),
            F.max(x).alias(f"max__{c}"),
            F.avg(number(df, c)).cast("double").alias(f"mean__{c}"),
            F.stddev_samp(x).alias(f"std__{c}"),
            (F.max(x) - F.min(x)).alias(f"range__{c}"),
        ]
        at = quartiles.get(c) or [None] * 3  # a column without values has none
        aggs += [F.lit(v).cast("double").alias(f"{q}__{c}") for q, v in zip(("p25", "p50", "p75"), at)]
    return _long(df.agg(*aggs), columns, ["count", "min", "max", "mean", "std", "range", "p25", "p50", "p75"], "feature")


def quantile_table(df: DataFrame, columns: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """One row per column and probability; see `quantiles` for how they are found."""
    values = quantiles(df, columns, probs)
    rows = [(c, float(p), v) for c, vs in values.items() for p, v in zip(probs, vs)]
    return df.sparkSession.createDataFrame(rows, "feature string, prob double, value double")


def frequencies(df: DataFrame, column: str, share: str = "share") -> DataFrame:
    """Row count of each value and its share of all non-null rows."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("total")).scalar()
    return counts.withColumn(share, F.col("n") / total)


def _unfolded(df: DataFrame, columns: dict[str, Column]) -> tuple[DataFrame, list[str]]:
    """(column number, value) of all non-null cells, values of each type in a field of their own."""
    types = dict(df.select(*[c.alias(n) for n, c in columns.items()]).dtypes)
    kinds = list(dict.fromkeys(types.values()))
    fields = [f"v{k}" for k in range(len(kinds))]
    cells = [
        F.when(c.isNotNull(), F.struct(F.lit(at).alias("at"), *[
            (c if types[n] == kind else F.lit(None)).cast(kind).alias(f) for f, kind in zip(fields, kinds)
        ]))
        for at, (n, c) in enumerate(columns.items())
    ]
    return df.select(F.inline(F.filter(F.array(*cells), lambda x: x.isNotNull()))), fields


def _most_frequent(df: DataFrame, columns: dict[str, Column]) -> dict:
    """column -> (value, count), from one aggregate over all columns."""
    cells, fields = _unfolded(df, columns)
    counts = cells.groupBy("at", *fields).agg(F.count(F.lit(1)).alias("n"))
    best = counts.groupBy("at").agg(F.min(F.struct((-F.col("n")).alias("n"), *fields)).alias("best"))
    names, found = list(columns), {}
    for r in best.collect():
        value = next((r["best"][f] for f in fields if r["best"][f] is not None), None)
        found[names[r["at"]]] = value, -r["best"]["n"]
    return found


def modes(df: DataFrame, columns: Sequence[str], support: float | None = None) -> dict:
    """column -> most frequent value, the smallest of equals; None without values.

    One job for any number of columns: the cells are unfolded once, and equal
    ones combine before they move. With `support`, a share such as 0.001, a
    sketch of frequent items goes first: only its at most 1 / support values of
    each column are counted, which spares shuffling columns that are nearly all
    distinct. A value above that share is always among them; a column without
    one is counted in full, so the result is the same.
    """
    found: dict = {}
    if support and columns:
        few = df.stat.freqItems(list(columns), support)
        total, few = df.agg(*[F.count(c).alias(c) for c in columns]).first(), few.first()
        items = {c: few[f"{c}_freqItems"] or [] for c in columns}
        among = {c: F.when(F.col(c).isin([v for v in items[c] if v is not None]), F.col(c)) for c in columns}
        found = _most_frequent(df, among)
        found = {c: f for c, f in found.items() if f[1] * int(1 / support) > total[c]}
    rest = [c for c in columns if c not in found]
    if rest:
        found |= _most_frequent(df, {c: F.col(c) for c in rest})
    return {c: found[c][0] if c in found else None for c in columns}


def mode_value(df: DataFrame, column: str):
    """Most frequent value, the smallest of equals; None without values."""
    return modes(df, [column])[column]


def distinct_counts(df: DataFrame, keys: dict[str, Column], columns: dict[str, str]) -> DataFrame:
    """Several distinct counts per key: name -> number of the column's different non-null values.

    Each column is reduced to its (key, value) pairs by a scan of its own, which
    reads no other column; the tagged pairs are then counted per key. No row is
    copied once for each count, as several distinct aggregates at once would do.
    """
    pairs = [
        df.select(*[c.alias(k) for k, c in keys.items()], F.col(column).alias("_value")).distinct()
        .select(*keys, F.when(F.col("_value").isNotNull(), F.lit(at)).alias("_tag"))
        for at, column in enumerate(columns.values())
    ]
    return reduce(DataFrame.unionByName, pairs).groupBy(*keys).agg(
        *[F.count(F.when(F.col("_tag") == at, F.lit(1))).alias(name) for at, name in enumerate(columns)])


def null_counts(df: DataFrame) -> list[Column]:
    return [F.count(F.when(F.col(c).isNull(), F.lit(1))).alias(c) for c in df.columns]


def missing_profile(df: DataFrame) -> DataFrame:
    """Missing cells per column and their percentage, one pass."""
    aggs = [F.count(F.lit(1)).alias("_rows")]
    aggs += [F.count(F.when(F.col(c).isNull(), F.lit(1))).alias(f"missing__{c}") for c in df.columns]
    row = df.agg(*aggs)
    items = F.array(*[
        F.struct(
            F.lit(c).alias("column_name"),
            F.col(f"missing__{c}").alias("missing_count"),
            (F.col(f"missing__{c}") * 100.0 / F.col("_rows")).alias("missing_pct"),
        )
        for c in df.columns
    ])
    return row.select(F.inline(items))


def row_key(df: DataFrame, keys: Sequence[str | Column]) -> Column:
    """The given columns as one grouping key: text shuffles as a 32-byte digest, other values keep their type.

    Typed values compare as DISTINCT compares them: timestamps to the
    microsecond, -0.0 as 0.0. Maps can't be grouped and go into the digest.
    """
    cols = [F.col(k) if isinstance(k, str) else k for k in keys]
    named = [c.alias(f"k{i}") for i, c in enumerate(cols)]
    types = [dtype for _, dtype in df.select(*named).dtypes]
    if types == ["string"]:
        return F.unhex(F.sha2(cols[0], 256))
    long = [c for c, dtype in zip(named, types) if dtype == "string" or "map<" in dtype]
    plain = [c for c, dtype in zip(named, types) if not (dtype == "string" or "map<" in dtype)]
    if not long:
        return F.struct(*plain)
    return F.struct(*plain, F.unhex(F.sha2(F.to_json(F.struct(*long)), 256)).alias("digest"))


def distinct_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(rows, groups) of the given columns: copies combine before the shuffle."""
    key = row_key(df, columns or df.columns).alias("_key")
    groups = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    return groups.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"), F.count(F.lit(1)).alias("groups")
    )


def quality_profile(df: DataFrame, per_column: bool = False) -> DataFrame:
    """Rows, columns, missing cells with percentage, duplicate rows; one pass over the rows.

    Copies are counted before the shuffle, and the null cells are summed per
    distinct row on the way. `per_column` adds `missing__<column>` counts.
    """
    names = df.columns
    is_null = {f"missing__{c}": F.col(c).isNull().cast("bigint") for c in names}
    if not per_column:
        is_null = {"_nulls": sum(is_null.values(), F.lit(0).cast("bigint"))}
    groups = df.groupBy(row_key(df, names).alias("_key")).agg(
        F.count(F.lit(1)).alias("_n"), *[F.sum(x).alias(n) for n, x in is_null.items()]
    )
    out = groups.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("total_rows"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicate_rows"),
        *[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in is_null],
    )
    missing = sum((F.col(n) for n in is_null), F.lit(0).cast("bigint"))
    return out.select(
        "total_rows",
        F.lit(len(names)).cast("bigint").alias("total_columns"),
        missing.alias("missing_values"),
        F.try_divide(missing * F.lit(100.0), F.col("total_rows") * len(names)).alias("missing_percentage"),
        "duplicate_rows",
        *(is_null if per_column else ()),
    )
