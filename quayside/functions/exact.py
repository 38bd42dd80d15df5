"""Arithmetic that gives the same digits whatever the order of the rows.

Sums of doubles depend on the order in which partial sums meet, so columns that
are declared as money are summed as decimals. Averages are an exact sum over a
count. Columns of other kinds keep all their digits: see `number`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c, precision: int = 18, scale: int = 2) -> Column:
    return _c(c).cast(f"decimal({precision},{scale})")


def number(df: DataFrame, name: str) -> Column:
    """The column for sums and means of any kind of number: decimals as they are, others as doubles."""
    return F.col(name) if isinstance(df.schema[name].dataType, T.DecimalType) else F.col(name).cast("double")


def exact_sum(c, scale: int = 2) -> Column:
    return F.sum(money(c, 18, scale)).cast("double")


def exact_mean(c, scale: int = 2) -> Column:
    """Null on empty input, as AVG is."""
    return F.try_divide(exact_sum(c, scale), F.count(_c(c)).cast("double"))


def round_half_up(c, digits: int = 2) -> Column:
    """Decimal rounding of a double, ties away from zero."""
    return F.round(_c(c).cast("decimal(30,10)"), digits).cast("double")


def line_total(price="l_extendedprice", discount="l_discount") -> Column:
    """price * (1 - discount) as decimal(17,4), which still fits one machine word."""
    return _c(price).cast("decimal(12,2)") * (F.lit(1) - _c(discount).cast("decimal(3,2)"))
