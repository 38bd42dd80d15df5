"""Categorical encodings."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from quayside.functions.nested import lookup
from quayside.operators.ordered import MIN_ROWS, with_position
from quayside.operators.profile import frequencies


def quoted(name: str) -> Column:
    """The column of that very name, dots and backticks included."""
    return F.col(f"`{name.replace('`', '``')}`")


def level_table(df: DataFrame, column: str, min_rows: int = MIN_ROWS) -> DataFrame:
    """level, level_no: the distinct values numbered from 0 in their order.

    A dictionary that may be saved and used on other tables. The values are
    distinct before they are sorted, and the sort is split over ordered parts,
    so any number of levels can be numbered.
    """
    found = df.select(F.col(column).alias("level")).filter(F.col("level").isNotNull()).distinct()
    return with_position(found, "level", name="level_no", min_rows=min_rows).select("level", (F.col("level_no") - 1).alias("level_no"))


def column_names(values: Iterable, start: str, taken: Iterable[str] = ()) -> list[str]:
    """`start` and the value as it is, for each value.

    Column names don't tell upper from lower case; a name that is taken gets
    `_2`, `_3` ... behind it, in the order of the values.
    """
    used, out = {t.lower() for t in taken}, []
    for v in values:
        name, k = f"{start}{v}", 1
        while name.lower() in used:
            k += 1
            name = f"{start}{v}_{k}"
        used.add(name.lower())
        out.append(name)
    return out


def one_hot(df: DataFrame, column: str, prefix: str | None = None, values: Sequence | None = None) -> DataFrame:
    """One 0/1 column per level, `<prefix>_<value>`; the source column goes, as in a dummy encoding.

    The levels are `values`, or all that are found, whose number the caller
    answers for: they become the schema. `one_hot_vector` encodes any number of
    levels in one column. Nulls are 0 everywhere.
    """
    if values is None:
        values = sorted(r[0] for r in df.select(column).filter(F.col(column).isNotNull()).distinct().collect())
    others = [c for c in df.columns if c != column]
    flags = [
        F.coalesce((quoted(column) == F.lit(v)).cast("int"), F.lit(0)).alias(name)
        for v, name in zip(values, column_names(values, f"{prefix or column}_", others))
    ]
    return df.select(*map(quoted, others), *flags)


def one_hot_vector(df: DataFrame, column: str, levels: DataFrame, name: str) -> DataFrame:
    """Adds a sparse 0/1 vector: struct of size, indices and values.

    `levels` is a `level_table`, of this table or another. Nulls and values that
    it lacks have no index. The join is left to the adaptive planner, as the
    dictionary may be large: small ones are broadcast, hot values' rows are split.
    """
    size = levels.agg(F.count(F.lit(1)).alias("n")).scalar()
    known = levels.select(F.col("level").alias("_level"), F.col("level_no").alias("_no"))
    found = F.col("_no").isNotNull()
    vector = F.struct(
        size.alias("size"),
        F.when(found, F.array("_no")).otherwise(F.array().cast("array<bigint>")).alias("indices"),
        F.when(found, F.array(F.lit(1))).otherwise(F.array().cast("array<int>")).alias("values"),
    )
    return df.join(known, F.col(column) == F.col("_level"), "left").withColumn(name, vector).drop("_level", "_no")


def at_level(vector: Column, level_no) -> Column:
    """0 or 1: the vector's value at a level number."""
    return F.array_contains(vector["indices"], F.lit(level_no).cast("bigint")).cast("int")


def label_encode(df: DataFrame, column: str, mapping: dict, name: str) -> DataFrame:
    return df.withColumn(name, lookup(column, mapping))


def frequency_encode(df: DataFrame, column: str, name: str) -> DataFrame:
    """Each value's share of the non-null rows, joined back on the value.

    The counts combine before the shuffle. The join is left to the adaptive
    planner: it broadcasts the counts when they turn out small, and otherwise
    splits the hot values' rows.
    """
    shares = frequencies(df, column, name).select(F.col(column).alias("_value"), name)
    return df.join(shares, F.col(column) == F.col("_value"), "left").drop("_value")
