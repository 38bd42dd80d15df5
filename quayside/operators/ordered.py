"""Window functions over groups too large for one task.

`OVER (ORDER BY x)` sends every row to one task, and `OVER (PARTITION BY k
ORDER BY x)` sends all rows of a hot key to one task. Here an oversized group
is first cut into ordered parts of bounded size:

1. one aggregate counts the rows and takes approximate quantiles of the order
   column; the cut points are the only values that reach the driver, so every
   later pass sees the same cuts;
2. each row gets the number of its part, and the window runs per part;
3. one row per part (its size, sum or last value) is turned into an offset and
   joined back by broadcast.

Rows equal in the order column share a part. A value that is itself a cut point
has a part of its own (odd number); where such a value is heavy, the part is cut
again by the next order column. Groups within the size limit are not touched:
their plan is the plain window.

Bounds: a group is cut only when it holds more than 1/fanout of all rows (and
more than `min_rows`), so there are at most `fanout` such groups and about
2 * fanout cut points. `fanout` is the session's shuffle partition count, 64 at
least. Those bounds are what makes the broadcasts here safe.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace
from functools import reduce
from itertools import accumulate
from math import ceil

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T
from pyspark.sql.window import WindowSpec

MIN_ROWS = 1000
PART = "_part"
WIDE = "_wide"
_SALT = "_salt"
_HALO = "_halo"


@dataclass(frozen=True)
class By:
    """One order column. Unless told otherwise nulls count as the largest value."""

    name: str
    desc: bool = False
    nulls_first: bool | None = None

    @property
    def _nulls_lead(self) -> bool:
        return self.desc if self.nulls_first is None else self.nulls_first

    def column(self) -> Column:
        c = F.col(self.name)
        if self.desc:
            return c.desc_nulls_first() if self._nulls_lead else c.desc_nulls_last()
        return c.asc_nulls_first() if self._nulls_lead else c.asc_nulls_last()

    def flipped(self) -> By:
        return replace(self, desc=not self.desc, nulls_first=not self._nulls_lead)

    def is_text(self, schema: T.StructType) -> bool:
        return isinstance(schema[self.name].dataType, T.StringType)

    def position(self, schema: T.StructType, start: int = 0) -> tuple[Column, float]:
        """A double that never decreases along the order, and a factor: while the largest
        |position| times the factor stays below 2**53, different values have different positions.

        Text is placed by the six bytes from `start` on, among texts that agree before it.
        """
        dtype = schema[self.name].dataType
        c, factor = F.col(self.name), 1.0
        if isinstance(dtype, T.DateType):
            found = F.unix_date(c)
        elif isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
            found = F.unix_micros(c.cast("timestamp"))
        elif isinstance(dtype, T.StringType):
            # The bytes, then how many there are: a text ends before one that goes on with zero bytes.
            block = F.substring(F.hex(F.encode(c, "UTF-8")), 2 * start + 1, 12)
            found = F.conv(F.rpad(block, 12, "0"), 16, 10).cast("double") * 8 + F.length(block) / 2
            factor = 0.0
        elif isinstance(dtype, T.DecimalType):
            found, factor = c, 10.0 ** dtype.scale
        elif isinstance(dtype, (T.DoubleType, T.FloatType)):
            found, factor = c, 0.0
        elif isinstance(dtype, (T.NumericType, T.BooleanType)):
            found = c
        else:
            raise TypeError(f"cannot order by {self.name}: {dtype.simpleString()}")
        edge = F.lit(float("-inf") if self._nulls_lead else float("inf"))
        return F.coalesce(-found.cast("double") if self.desc else found.cast("double"), edge), factor


def as_order(order) -> list[By]:
    """Accepts a name, a `By`, or a list of them; a leading '-' means descending."""
    items = [order] if isinstance(order, (str, By)) else list(order)
    return [
        o if isinstance(o, By) else By(o.lstrip("-"), desc=o.startswith("-"))
        for o in items
    ]


def fanout(df: DataFrame) -> int:
    configured = df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")
    return max(64, int(configured))


def attach(df: DataFrame, small: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    """Null-safe broadcast join with a table whose size the caller has bounded."""
    if not on:
        raise ValueError("attach needs join columns")
    renamed = small.select(
        *[F.col(n).alias(f"_on_{n}") for n in on],
        *[c for c in small.columns if c not in on],
    )
    cond = reduce(
        lambda a, b: a & b, [F.col(n).eqNullSafe(F.col(f"_on_{n}")) for n in on]
    )
    out = df.join(F.broadcast(renamed), cond, how)
    return out.drop(*[f"_on_{n}" for n in on])


def _doubles(values: Sequence[float]) -> Column:
    """A constant array, sent as one text instead of one literal per value."""
    return F.split(F.lit(",".join(map(repr, values))), ",").cast("array<double>")


def _quantiles(pos: Column, fan: int) -> Column:
    probs = _doubles([i / fan for i in range(1, fan)])
    return F.percentile_approx(pos, probs, F.lit(max(10000, 10 * fan)))


def _reach(pos: Column) -> Column:
    """Largest finite |position|."""
    return F.max(F.when(F.abs(pos) < F.lit(float("inf")), F.abs(pos)))


def _exact(reach: float | None, factor: float) -> bool:
    return factor == 0.0 or (reach or 0.0) * factor < 2**53


def _below(cuts: Column, x: Column, longest: int) -> Column:
    """How many of the ascending `cuts` lie below `x`, by binary search."""
    steps = [1 << b for b in reversed(range(max(1, longest).bit_length()))]
    return F.aggregate(
        F.array(*[F.lit(s) for s in steps]),
        F.lit(0),
        lambda at, s: F.when(F.get(cuts, at + s - 1) < x, at + s).otherwise(at),
    )


def _heavy(cuts: list[float]) -> list[float]:
    """Values found at more than one quantile: they hold more than a part's worth of rows."""
    return sorted({a for a, b in zip(cuts, cuts[1:]) if a == b})


def _spread(limit: int, fan: int) -> Column:
    """Of `fan` quantiles in `_q`, as many as `_n` rows need at `limit` rows per part."""
    parts = F.greatest(F.lit(2), F.ceil(F.col("_n") / F.lit(limit))).cast("int")
    return F.transform(
        F.sequence(F.lit(1), parts - 1),
        lambda i: F.get(F.col("_q"), (i * fan / parts).cast("int") - 1),
    )


def _cut(df: DataFrame, pos: Column, on: list[str], cells: dict[tuple, list[float]], exact: bool):
    """Adds `_sub`, the part number inside each cell (null outside the given cells).

    Cut values get parts of their own only where equal positions mean equal values.
    """
    distinct = {cell: sorted(set(cuts)) for cell, cuts in cells.items()}
    longest = max(map(len, distinct.values()))
    if on:
        types = [df.schema[n] for n in on]
        schema = T.StructType(
            [T.StructField(f.name, f.dataType) for f in types]
            + [T.StructField("_cuts", T.ArrayType(T.DoubleType()))]
        )
        rows = [(*cell, cuts) for cell, cuts in distinct.items()]
        df = attach(df, df.sparkSession.createDataFrame(rows, schema), on)
    else:
        df = df.withColumn("_cuts", _doubles(distinct[()]))
    cuts, at = F.col("_cuts"), _below(F.col("_cuts"), pos, longest)
    own = F.coalesce((F.get(cuts, at) == pos).cast("int"), F.lit(0)) if exact else F.lit(0)
    sub = F.when(cuts.isNotNull(), (2 * at + own).cast("bigint"))
    heavy = [
        (*cell, 2 * distinct[cell].index(v) + 1)
        for cell, raw in cells.items()
        for v in (_heavy(raw) if exact else ())
    ]
    return df.withColumn("_sub", sub).drop("_cuts"), heavy


def _first_difference(rows: DataFrame, name: str, on: list[str]) -> int | None:
    """Up to which byte all texts of a cell agree, the least over the cells; None when no cell holds different texts."""
    least, most = (F.hex(F.encode(f"_{x}", "UTF-8")) for x in ("least", "most"))
    longest = F.greatest(F.length(least), F.length(most))
    # Binary search for the length of the common beginning, in bytes.
    common = F.aggregate(
        F.transform(F.sequence(F.lit(28), F.lit(0), F.lit(-1)), lambda b: F.pow(F.lit(2), b).cast("int")),
        F.lit(0),
        lambda got, step: F.when(
            (2 * (got + step) <= longest) & (F.left(least, 2 * (got + step)) == F.left(most, 2 * (got + step))), got + step
        ).otherwise(got),
    )
    ends = rows.groupBy(*on).agg(F.min(name).alias("_least"), F.max(name).alias("_most"))
    return ends.filter(F.col("_least") != F.col("_most")).agg(F.min(common)).first()[0]


@dataclass
class Split:
    """`df` with part numbers; when no group was oversized it has no extra column."""

    df: DataFrame
    keys: list[str]
    order: list[By]
    wide: bool
    pure: bool = False  # odd parts hold a single value of the first order column

    @property
    def group(self) -> list[str]:
        return [*self.keys, PART] if self.wide else list(self.keys)

    def window(self, backwards: bool = False) -> WindowSpec:
        order = [o.flipped() if backwards else o for o in self.order]
        return Window.partitionBy(*self.group).orderBy(*[o.column() for o in order])

    def summary(self, *aggs: Column, df: DataFrame | None = None) -> DataFrame:
        """One row per part of the oversized groups: about 3 * fanout rows at most."""
        base = self.df if df is None else df
        return base.filter(F.col(WIDE)).groupBy(*self.group).agg(*aggs)

    def along_parts(self) -> WindowSpec:
        return Window.partitionBy(*self.keys).orderBy(PART)

    def strip(self, df: DataFrame) -> DataFrame:
        return df.drop(PART, WIDE, _SALT, _HALO)

    def plain(self) -> DataFrame:
        return self.strip(self.df)


def split(df: DataFrame, order, keys: Sequence[str] = (), min_rows: int = MIN_ROWS) -> Split:
    """Cut the oversized groups of `keys` (or the whole table) into ordered parts."""
    order, keys, fan = as_order(order), list(keys), fanout(df)
    schema = df.schema
    pos, factor = order[0].position(schema)

    if keys:
        sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
        total, largest = sizes.agg(F.sum("_n"), F.max("_n")).first()
        limit = max(min_rows, ceil((total or 0) / fan))
        if not total or largest <= limit:
            return Split(df, keys, order, False)
        hot = sizes.filter(F.col("_n") > limit)
        rows = (
            attach(df, hot, keys, "inner")
            .groupBy(*keys, "_n")
            .agg(_quantiles(pos, fan).alias("_q"), _reach(pos).alias("_reach"))
            .select(*keys, _spread(limit, fan).alias("_q"), "_reach")
            .collect()
        )
        cells = {tuple(r[k] for k in keys): list(r["_q"]) for r in rows}
        exact = all(_exact(r["_reach"], factor) for r in rows)
    else:
        total, q, reach = df.agg(F.count(F.lit(1)), _quantiles(pos, fan), _reach(pos)).first()
        limit = max(min_rows, ceil(total / fan))
        if total <= limit:
            return Split(df, keys, order, False)
        k = max(2, ceil(total / limit))
        cells = {(): [q[int(i * fan / k) - 1] for i in range(1, k)]}
        exact = _exact(reach, factor)

    pure = exact and not order[0].is_text(schema)
    out, heavy = _cut(df, pos, keys, cells, exact)
    if keys:
        out = out.withColumn(WIDE, F.col("_sub").isNotNull())
        out = out.withColumn(PART, F.coalesce("_sub", F.lit(0).cast("bigint"))).drop("_sub")
    else:
        out = out.withColumnRenamed("_sub", PART).withColumn(WIDE, F.lit(True))
    # The rows of one heavy position are told apart by further bytes of a text, then by the next order column.
    on = [*keys, PART]
    at, start = 0, 0
    while heavy:
        types = T.StructType([T.StructField(n, out.schema[n].dataType) for n in on])
        rows = attach(out, df.sparkSession.createDataFrame(heavy, types), on, "inner")
        if order[at].is_text(schema):
            start = _first_difference(rows, order[at].name, on)
        if start is None or not order[at].is_text(schema):
            at, start = at + 1, 0
            if at == len(order):
                break
        pos, factor = order[at].position(schema, start)
        rows = (
            rows.groupBy(*on)
            .agg(F.count(F.lit(1)).alias("_n"), _quantiles(pos, fan).alias("_q"), _reach(pos).alias("_reach"))
            .filter(F.col("_n") > limit)
            .select(*on, _spread(limit, fan).alias("_q"), "_reach")
            .collect()
        )
        cells = {tuple(r[n] for n in on): list(r["_q"]) for r in rows}
        if not cells:
            break
        out, deeper = _cut(out, pos, on, cells, all(_exact(r["_reach"], factor) for r in rows))
        # Each part that was cut makes room for its own parts, so numbers stay as small as the parts are few.
        room: dict[int, int] = {}
        for cell, cuts in cells.items():
            room[cell[-1]] = max(room.get(cell[-1], 0), 2 * len(set(cuts)))
        cut_parts = sorted(room)
        shifts = list(accumulate((room[p] for p in cut_parts), initial=0))
        number = lambda part, sub: part + shifts[bisect_left(cut_parts, part)] + sub
        shift = F.get(_doubles(shifts), _below(_doubles(cut_parts), F.col(PART).cast("double"), len(cut_parts)))
        out = out.withColumn(PART, F.col(PART) + shift.cast("bigint") + F.coalesce("_sub", F.lit(0).cast("bigint")))
        out = out.drop("_sub")
        heavy = [(*c[:-2], number(c[-2], c[-1])) for c in deeper]
    return Split(out, keys, order, True, pure)


def number_rows(s: Split, name: str, total: str | None = None) -> Split:
    """Adds ROW_NUMBER, and the group's row count when `total` names a column."""
    out = s.df.withColumn(name, F.row_number().over(s.window()).cast("bigint"))
    if total and not (s.wide and not s.keys):
        out = out.withColumn(total, F.count(F.lit(1)).over(Window.partitionBy(*s.group)))
    if not s.wide:
        return replace(s, df=out)
    before = s.along_parts().rowsBetween(Window.unboundedPreceding, -1)
    offsets = s.summary(F.count(F.lit(1)).alias("_n")).select(
        *s.group,
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
        F.sum("_n").over(Window.partitionBy(*s.keys)).alias("_all"),
    )
    out = attach(out, offsets, s.group)
    out = out.withColumn(name, F.col(name) + F.coalesce("_before", F.lit(0)))
    if total:
        out = out.withColumn(total, F.coalesce("_all", F.col(total)) if s.keys else F.col("_all"))
    return replace(s, df=out.drop("_before", "_all"))


def with_position(
    df: DataFrame, order, keys: Sequence[str] = (), name: str = "row_number",
    total: str | None = None, min_rows: int = MIN_ROWS,
) -> DataFrame:
    """ROW_NUMBER, and the group's row count when `total` names a column.

    `order` should end in a unique column, or equal rows are numbered freely.
    """
    return number_rows(split(df, order, keys, min_rows), name, total).plain()


def with_ntile(
    df: DataFrame, buckets: int, order, keys: Sequence[str] = (), name: str = "ntile",
    min_rows: int = MIN_ROWS,
) -> DataFrame:
    """NTILE(buckets) from the row number and the group's size."""
    out = with_position(df, order, keys, "_rn", "_size", min_rows)
    small = F.floor(F.col("_size") / buckets)
    extra = F.col("_size") - small * buckets
    edge = extra * (small + 1)
    late = extra + F.ceil((F.col("_rn") - edge) / F.greatest(small, F.lit(1)))
    bucket = F.when(F.col("_rn") <= edge, F.ceil(F.col("_rn") / (small + 1))).otherwise(late)
    return out.withColumn(name, bucket.cast("bigint")).drop("_rn", "_size")


def with_rank(
    df: DataFrame, by, keys: Sequence[str] = (), rank: str | None = None,
    dense: str | None = None, percent: str | None = None, min_rows: int = MIN_ROWS,
) -> DataFrame:
    """RANK, DENSE_RANK and PERCENT_RANK by one column; ties share a rank."""
    order = as_order(by)
    if len(order) != 1:
        raise ValueError("with_rank takes one order column")
    s = split(df, order, keys, min_rows)
    out = s.df
    within = list(s.group)
    if s.wide:
        if s.pure:
            # An odd part holds one value only, so any subset of it ranks alike.
            out = out.withColumn(_SALT, F.when(F.col(PART) % 2 == 1, F.spark_partition_id()).otherwise(0))
            within.append(_SALT)
    w = Window.partitionBy(*within).orderBy(order[0].column())
    out = out.withColumn("_rank", F.rank().over(w).cast("bigint"))
    if dense:
        out = out.withColumn("_dense", F.dense_rank().over(w).cast("bigint"))
    if percent and not s.wide:
        out = out.withColumn("_all", F.count(F.lit(1)).over(Window.partitionBy(*s.group)))
    if s.wide:
        aggs = [F.count(F.lit(1)).alias("_n")]
        if dense:
            aggs.append(F.max("_dense").alias("_d"))
        before = s.along_parts().rowsBetween(Window.unboundedPreceding, -1)
        cols = [F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")]
        cols.append(F.sum("_n").over(Window.partitionBy(*s.keys)).alias("_wide_all"))
        if dense:
            cols.append(F.coalesce(F.sum("_d").over(before), F.lit(0)).alias("_dense_before"))
        offsets = s.summary(*aggs, df=out if dense else None).select(*s.group, *cols)
        if percent and s.keys:
            out = out.withColumn("_all", F.when(~F.col(WIDE), F.count(F.lit(1)).over(Window.partitionBy(*within))))
        elif percent:
            out = out.withColumn("_all", F.lit(None).cast("bigint"))
        out = attach(out, offsets, s.group)
        out = out.withColumn("_rank", F.col("_rank") + F.coalesce("_before", F.lit(0)))
        if dense:
            out = out.withColumn("_dense", F.col("_dense") + F.coalesce("_dense_before", F.lit(0)))
        if percent:
            out = out.withColumn("_all", F.coalesce("_wide_all", "_all"))
    if percent:
        share = (F.col("_rank") - 1).cast("double") / F.greatest(F.col("_all") - 1, F.lit(1))
        out = out.withColumn(percent, share)
    if rank:
        out = out.withColumn(rank, F.col("_rank"))
    if dense:
        out = out.withColumn(dense, F.col("_dense"))
    drop = ["_rank", "_dense", "_all", "_before", "_wide_all", "_dense_before"]
    return s.strip(out.drop(*drop))


def with_running(
    df: DataFrame, order, sums: dict[str, Column | str], keys: Sequence[str] = (),
    min_rows: int = MIN_ROWS,
) -> DataFrame:
    """Running sums, ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW."""
    s = split(df, order, keys, min_rows)
    w = s.window().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    values = {n: F.col(c) if isinstance(c, str) else c for n, c in sums.items()}
    if not s.wide:
        return s.df.withColumns({n: F.sum(c).over(w) for n, c in values.items()})
    before = s.along_parts().rowsBetween(Window.unboundedPreceding, -1)
    carried = s.summary(*[F.sum(c).alias(f"_s_{n}") for n, c in values.items()]).select(
        *s.group, *[F.sum(f"_s_{n}").over(before).alias(f"_c_{n}") for n in values]
    )
    out = s.df.withColumns({f"_l_{n}": F.sum(c).over(w) for n, c in values.items()})
    out = attach(out, carried, s.group)
    out = out.withColumns({
        n: F.coalesce(F.col(f"_l_{n}") + F.col(f"_c_{n}"), f"_l_{n}", f"_c_{n}") for n in values
    })
    return s.strip(out.drop(*[f"_{x}_{n}" for n in values for x in "lc"]))


def with_range_running(
    df: DataFrame, by, sums: dict[str, Column | str], keys: Sequence[str] = (),
    min_rows: int = MIN_ROWS,
) -> DataFrame:
    """Running sums with the default RANGE frame: rows equal in `by` share a value.

    The rows are first summed per value, so the ordered pass sees each value
    once, and a heavy value never meets in one task.
    """
    order = as_order(by)
    if len(order) != 1:
        raise ValueError("with_range_running takes one order column")
    values = {n: F.col(c) if isinstance(c, str) else c for n, c in sums.items()}
    on = [*keys, order[0].name]
    per_value = df.groupBy(*on).agg(*[F.sum(c).alias(f"_v_{n}") for n, c in values.items()])
    run = with_running(per_value, order, {n: f"_v_{n}" for n in values}, keys, min_rows)
    run = run.select(*[F.col(n).alias(f"_on_{n}") for n in on], *values)
    cond = reduce(lambda a, b: a & b, [F.col(n).eqNullSafe(F.col(f"_on_{n}")) for n in on])
    return df.join(run, cond, "left").drop(*[f"_on_{n}" for n in on])


def _edge_rows(s: Split, rows: int, following: bool) -> DataFrame:
    """For each part, the `rows` rows of its group just before (or after) it.

    They come from the neighbouring part, and from parts further off only where
    those between are shorter than the frame. Which part takes how many rows
    from which is worked out on one row per part; the rows themselves meet only
    inside their part.
    """
    order = [o.column() for o in s.order] if following else [o.flipped().column() for o in s.order]
    rank = F.row_number().over(Window.partitionBy(*s.group).orderBy(*order))
    edge = s.df.filter(F.col(WIDE)).withColumn("_r", rank).filter(F.col("_r") <= rows)
    along = Window.partitionBy(*s.keys).orderBy((-1 if following else 1) * F.col(PART))
    ends = s.summary(F.count(F.lit(1)).alias("_n")).withColumn(
        "_end", F.sum("_n").over(along.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    )
    near = Window.partitionBy(*s.keys).orderBy("_end").rangeBetween(-(rows - 1), 0)
    source = F.struct(F.col(PART).alias("part"), F.col("_end").alias("end"))
    wanted = ends.select(
        *s.keys, "_end", F.lead(PART).over(along).alias("_to"), F.collect_list(source).over(near).alias("_from")
    )
    wanted = wanted.filter(F.col("_to").isNotNull()).select(*s.keys, "_end", "_to", F.explode("_from").alias("_from"))
    wanted = wanted.select(
        *s.keys, F.col("_from.part").alias(PART), "_to", (rows - F.col("_end") + F.col("_from.end")).alias("_take")
    )
    copies = attach(edge, wanted, s.group, "inner").filter(F.col("_r") <= F.col("_take"))
    return copies.drop(PART, "_r", "_take").withColumnRenamed("_to", PART)


def with_neighbours(
    df: DataFrame, order, columns: Callable[[WindowSpec], dict[str, Column]],
    keys: Sequence[str] = (), before: int = 0, after: int = 0, min_rows: int = MIN_ROWS,
    totals: dict[str, Column] | None = None,
) -> DataFrame:
    """Window columns that look at most `before` rows back and `after` rows ahead.

    `columns` receives the ordered window and returns the new columns. Parts of
    an oversized group get copies of the neighbouring rows they look at.

    `totals` are aggregates per key beside every row. They read the rows where
    the ordered window left them, so both cost one exchange; the few oversized
    groups are aggregated apart, one row each.
    """
    s = split(df, order, keys, min_rows)
    totals = totals or {}
    whole = Window.partitionBy(*s.group)
    if not s.wide:
        return s.df.withColumns(columns(s.window())).withColumns({n: a.over(whole) for n, a in totals.items()})
    out = s.df.withColumn(_HALO, F.lit(False))
    for rows, following in ((before, False), (after, True)):
        if rows:
            out = out.unionByName(_edge_rows(s, rows, following).withColumn(_HALO, F.lit(True)))
    out = out.withColumns(columns(s.window())).withColumns({n: a.over(whole) for n, a in totals.items()})
    out = out.filter(~F.col(_HALO))
    if totals and s.keys:
        hot = s.df.filter(F.col(WIDE)).groupBy(*s.keys).agg(*[a.alias(f"_t_{n}") for n, a in totals.items()])
        out = attach(out, hot, s.keys)
        out = out.withColumns({n: F.when(F.col(WIDE), F.col(f"_t_{n}")).otherwise(F.col(n)) for n in totals})
        out = out.drop(*[f"_t_{n}" for n in totals])
    elif totals:
        one = s.df.agg(*[a.alias(f"_t_{n}") for n, a in totals.items()])
        out = out.withColumns({n: one.select(f"_t_{n}").scalar() for n in totals})
    return s.strip(out)


def carry(
    s: Split, forward: dict[str, Column | str] | None = None, backward: dict[str, Column | str] | None = None,
) -> Split:
    """Adds the last non-null value up to the row (`forward`) and the next one from it (`backward`)."""
    # Looking ahead is looking back along the flipped order: a frame that ends
    # at UNBOUNDED FOLLOWING is evaluated anew for every row.
    so_far = (Window.unboundedPreceding, Window.currentRow)
    ahead, back = s.window().rowsBetween(*so_far), s.window(backwards=True).rowsBetween(*so_far)
    col = lambda c: F.col(c) if isinstance(c, str) else c
    fwd = {n: col(c) for n, c in (forward or {}).items()}
    bwd = {n: col(c) for n, c in (backward or {}).items()}
    local = {n: F.last(c, ignorenulls=True).over(ahead) for n, c in fwd.items()}
    local |= {n: F.last(c, ignorenulls=True).over(back) for n, c in bwd.items()}
    if not s.wide:
        return replace(s, df=s.df.withColumns(local))
    if any(o.desc for o in s.order):
        raise ValueError("carry needs ascending order columns")
    place = F.struct(*[
        c for o in s.order
        for c in (F.isnotnull(o.name) if o._nulls_lead else F.isnull(o.name), F.col(o.name))
    ])
    aggs = [F.max_by(c, F.when(c.isNotNull(), place)).alias(f"_e_{n}") for n, c in fwd.items()]
    aggs += [F.min_by(c, F.when(c.isNotNull(), place)).alias(f"_e_{n}") for n, c in bwd.items()]
    earlier = s.along_parts().rowsBetween(Window.unboundedPreceding, -1)
    later = Window.partitionBy(*s.keys).orderBy(F.col(PART).desc()).rowsBetween(Window.unboundedPreceding, -1)
    edges = s.summary(*aggs).select(
        *s.group,
        *[F.last(f"_e_{n}", ignorenulls=True).over(earlier).alias(f"_c_{n}") for n in fwd],
        *[F.last(f"_e_{n}", ignorenulls=True).over(later).alias(f"_c_{n}") for n in bwd],
    )
    out = attach(s.df.withColumns({f"_l_{n}": c for n, c in local.items()}), edges, s.group)
    names = [*fwd, *bwd]
    out = out.withColumns({n: F.coalesce(f"_l_{n}", f"_c_{n}") for n in names})
    return replace(s, df=out.drop(*[f"_{x}_{n}" for n in names for x in "lc"]))


def with_carry(
    df: DataFrame, order, forward: dict[str, Column | str] | None = None,
    backward: dict[str, Column | str] | None = None, keys: Sequence[str] = (),
    min_rows: int = MIN_ROWS,
) -> DataFrame:
    """Last non-null value up to the row (`forward`), next non-null from it (`backward`)."""
    return carry(split(df, order, keys, min_rows), forward, backward).plain()


def back_to_rows(df: DataFrame, keys: Sequence[str], *aggs: Column) -> DataFrame:
    """Aggregates per key beside every row, as `agg OVER (PARTITION BY keys)`.

    Group and join instead of a window: the aggregate combines before the
    shuffle, and a hot key's rows are split by the adaptive skew join.
    """
    stats = df.groupBy(*keys).agg(*aggs)
    names = [c for c in stats.columns if c not in keys]
    stats = stats.select(*[F.col(k).alias(f"_on_{k}") for k in keys], *names)
    cond = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_on_{k}")) for k in keys])
    return df.join(stats, cond, "left").drop(*[f"_on_{k}" for k in keys])


def top_with_ties(df: DataFrame, by: str, k: int, rank: str = "rank") -> DataFrame:
    """Rows with RANK() <= k by `by` descending, ties kept.

    Only the k largest distinct values meet in one place; the rows themselves
    are picked by a broadcast join with those at most k values.
    """
    best = df.groupBy(by).agg(F.count(F.lit(1)).alias("_n")).orderBy(F.col(by).desc()).limit(k)
    ahead = Window.orderBy(F.col(by).desc()).rowsBetween(Window.unboundedPreceding, -1)
    ranked = best.select(by, (F.coalesce(F.sum("_n").over(ahead), F.lit(0)) + 1).alias(rank))
    return attach(df, ranked.filter(F.col(rank) <= k), [by], "inner")
