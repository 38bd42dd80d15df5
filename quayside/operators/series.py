"""Operations on an ordered series: fills, interpolation, moving averages."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, Window, functions as F

from quayside.functions.exact import number
from quayside.operators.ordered import MIN_ROWS, as_order, carry, number_rows, split, with_carry, with_neighbours
from quayside.session import materialise


def ffill_bfill(df: DataFrame, order, columns: Sequence[str], keys: Sequence[str] = (),
                min_rows: int = MIN_ROWS) -> DataFrame:
    """`<c>_ffill` repeats the last known value, `<c>_bfill` takes the next one."""
    return with_carry(
        df, order,
        {f"{c}_ffill": c for c in columns}, {f"{c}_bfill": c for c in columns}, keys, min_rows,
    )


def interpolate_linear(df: DataFrame, order, column: str, name: str, keys: Sequence[str] = (),
                       min_rows: int = MIN_ROWS) -> DataFrame:
    """Straight line by row position; a leading gap stays null, a trailing one repeats the last value."""
    s = number_rows(split(df, order, keys, min_rows), "_at")
    known = F.when(F.col(column).isNotNull(), F.struct(F.col("_at").alias("at"), F.col(column).cast("double").alias("v")))
    s = carry(replace(s, df=s.df.withColumn("_known", known)), {"_p": "_known"}, {"_n": "_known"})
    step = (F.col("_n.v") - F.col("_p.v")) / (F.col("_n.at") - F.col("_p.at")).cast("double")
    line = F.col("_p.v") + step * (F.col("_at") - F.col("_p.at"))
    value = (
        F.when(F.col(column).isNotNull(), F.col(column).cast("double"))
        .when(F.col("_p").isNull(), None)
        .when(F.col("_n").isNull(), F.col("_p.v"))
        .otherwise(line)
    )
    return s.plain().withColumn(name, value).drop("_at", "_known", "_p", "_n")


def interpolate_quadratic(df: DataFrame, order, column: str, name: str, keys: Sequence[str] = (),
                          min_rows: int = MIN_ROWS) -> DataFrame:
    """Parabola through the three nearest known points, by row position.

    A local rule: each gap is filled from the two known points on one side and
    the one on the other (the nearer third), so values differ from a spline
    fitted to the whole series. Outside the known points, and with fewer than
    three of them, the gap stays null.
    """
    # Numbered once and written: known points, gaps and both ordered passes read it.
    out = materialise(number_rows(split(df, order, keys, min_rows), "_at").plain(), "numbered")
    point = F.struct(F.col("_at").alias("at"), F.col(column).cast("double").alias("v"))
    known = out.filter(F.col(column).isNotNull()).withColumn("_pt", point)
    # Each known point learns its neighbours among the known points.
    known = with_neighbours(
        known, order,
        lambda w: {"_before": F.lag("_pt", 1).over(w), "_after": F.lead("_pt", 1).over(w)},
        keys, before=1, after=1, min_rows=min_rows,
    )
    triple = F.struct(F.col("_pt"), F.col("_before"), F.col("_after")).alias("_tri")
    gaps = out.filter(F.col(column).isNull()).withColumn("_tri", F.lit(None).cast(known.select(triple).schema["_tri"].dataType))
    both = known.withColumn("_tri", triple).drop("_pt", "_before", "_after").unionByName(gaps)
    both = with_carry(both, order, {"_l": "_tri"}, {"_r": "_tri"}, keys, min_rows)
    left, right = F.col("_l._pt"), F.col("_r._pt")
    far_left, far_right = F.col("_l._before"), F.col("_r._after")
    x = F.col("_at").cast("double")
    use_left = far_left.isNotNull() & (
        far_right.isNull() | (x - far_left["at"] <= far_right["at"] - x)
    )
    third = F.when(use_left, far_left).otherwise(far_right)

    def term(p, q, r):
        return p["v"] * ((x - q["at"]) * (x - r["at"])) / ((p["at"] - q["at"]) * (p["at"] - r["at"])).cast("double")

    parabola = term(left, right, third) + term(right, left, third) + term(third, left, right)
    value = F.when(F.col(column).isNotNull(), F.col(column).cast("double")).when(
        left.isNotNull() & right.isNotNull() & third.isNotNull(), parabola
    )
    return both.withColumn(name, value).drop("_at", "_tri", "_l", "_r")


def moving_averages(df: DataFrame, order, column: str, windows: dict[str, int], keys: Sequence[str] = (),
                    full_only: bool = False, min_rows: int = MIN_ROWS) -> DataFrame:
    """name -> mean of the row and the size - 1 rows before it; `full_only` drops
    rows whose longest window is not yet full."""
    longest = max(windows.values())

    def columns(w):
        def mean(size: int):
            frame = w.rowsBetween(-(size - 1), Window.currentRow)
            total = F.sum(number(df, column)).over(frame).cast("double")
            return F.try_divide(total, F.count(column).over(frame))

        new = {name: mean(size) for name, size in windows.items()}
        if full_only:
            new["_rows"] = F.count(F.lit(1)).over(w.rowsBetween(-(longest - 1), Window.currentRow))
        return new

    out = with_neighbours(df, order, columns, keys, before=longest - 1, min_rows=min_rows)
    return out.filter(F.col("_rows") == longest).drop("_rows") if full_only else out


def moving_average(df: DataFrame, order, column: str, window: int, name: str,
                   keys: Sequence[str] = (), full_only: bool = False,
                   min_rows: int = MIN_ROWS) -> DataFrame:
    """One moving average; see `moving_averages`."""
    return moving_averages(df, order, column, {name: window}, keys, full_only, min_rows)


def lag_columns(df: DataFrame, time: str, value: str, prefix: str = "prev"):
    """For `with_neighbours`, two rows back: the last two values, the mean of three, whole days since the last row."""

    def columns(w):
        frame = w.rowsBetween(-2, Window.currentRow)
        total = F.sum(number(df, value)).over(frame).cast("double")
        gap = F.unix_micros(F.col(time).cast("timestamp")) - F.unix_micros(F.lag(time, 1).over(w).cast("timestamp"))
        return {
            f"{prefix}_value": F.lag(value, 1).over(w),
            f"{prefix}_2_value": F.lag(value, 2).over(w),
            "rolling_avg_3": F.try_divide(total, F.count(value).over(frame)),
            "days_since_last": F.floor(gap / F.lit(86_400_000_000)).cast("bigint"),
        }

    return columns


def lag_features(df: DataFrame, keys: Sequence[str], time: str, order, value: str,
                 prefix: str = "prev", min_rows: int = MIN_ROWS) -> DataFrame:
    """Per key: the last two values, the mean of three, whole days since the last row."""
    return with_neighbours(df, as_order(order), lag_columns(df, time, value, prefix), keys, before=2, min_rows=min_rows)
