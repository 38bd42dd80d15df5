"""Exact quantiles with linear interpolation, without one big aggregate buffer.

`percentile` keeps a count for every distinct value in a single buffer. Here the
wanted ranks are bracketed instead: an approximate quantile pass gives an
interval that must contain each rank, the next pass counts the rows below and
inside it, and the interval is narrowed until few distinct values are left.
Each pass is one scan with a partial aggregate; a pass narrows an interval to
about 1/2500 of its rows, so even 10^12 rows need three or four.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from math import ceil, floor

from pyspark.sql import DataFrame, Window, functions as F

ACCURACY = 10_000
FEW_VALUES = 100_000


@dataclass
class _Target:
    """Ranks `low`..`high` (0-based) of `column` lie within [`start`, `stop`]."""

    column: str
    low: int
    high: int
    start: float | None = None
    stop: float | None = None
    below: int = 0
    inside: int = 0
    slack: float = 2.0

    def widen(self, rows: int) -> None:
        """Start over with a wider bracket."""
        self.start = self.stop = None
        self.below, self.inside, self.slack = 0, rows, self.slack * 4

    def holds_rank(self) -> bool:
        return self.below <= self.low and self.high < self.below + self.inside

    def test(self):
        c = F.col(self.column)
        if self.start is None:
            return c.isNotNull()
        return (c >= self.start) & (c <= self.stop)


def quantiles(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float],
    few_values: int = FEW_VALUES, accuracy: int = ACCURACY,
) -> dict[str, list[float | None]]:
    """column -> values at `probs`; None for a column without values."""
    columns = list(dict.fromkeys(columns))
    base = df.select(*[F.col(c).cast("double").alias(f"q{i}") for i, c in enumerate(columns)])
    base = base.select(*[F.when(~F.isnan(c), F.col(c)).alias(c) for c in base.columns])
    # The sketch may be off by 1/accuracy of the rows either way; three times
    # that also covers the rounding of a rank, once there are enough rows.
    slack = 3.0 / accuracy
    around = F.array(*[F.lit(min(1.0, max(0.0, p + d))) for p in probs for d in (-slack, slack)])
    first = base.agg(*[
        x for c in base.columns for x in (
            F.count(c).alias(f"n_{c}"), F.min(c).alias(f"lo_{c}"), F.max(c).alias(f"hi_{c}"),
            F.percentile_approx(c, around, F.lit(accuracy)).alias(f"a_{c}"),
        )
    ]).first()
    counts = {c: first[f"n_{c}"] for c in base.columns}
    targets: dict[tuple[str, float], _Target] = {}
    found: dict[tuple[str, float], tuple[float, float]] = {}
    few: list[tuple[str, float]] = []
    open_keys: list[tuple[str, float]] = []
    for c, n in counts.items():
        for i, p in enumerate(probs if n else ()):
            at = (n - 1) * p
            t = targets[c, p] = _Target(c, floor(at), ceil(at), inside=n)
            if n <= few_values:
                t.start, t.stop = first[f"lo_{c}"], first[f"hi_{c}"]
                few.append((c, p))
            else:
                if n >= accuracy:
                    t.start, t.stop = first[f"a_{c}"][2 * i], first[f"a_{c}"][2 * i + 1]
                open_keys.append((c, p))
    found.update(zip(few, _pick(base, [targets[k] for k in few])))
    fresh = [k for k in open_keys if targets[k].start is not None]
    while open_keys:
        _narrow(base, [targets[k] for k in open_keys if k not in fresh], accuracy)
        fresh = []
        still = []
        sizes = _measure(base, [targets[k] for k in open_keys])
        ready = []
        for k, distinct in zip(open_keys, sizes):
            t = targets[k]
            if not t.holds_rank():
                t.widen(counts[t.column])
                still.append(k)
            elif t.start == t.stop:
                found[k] = (t.start, t.stop)
            elif distinct <= few_values:
                ready.append(k)
            else:
                still.append(k)
        for k, pair in zip(ready, _pick(base, [targets[k] for k in ready])):
            found[k] = pair
        open_keys = still

    result = {}
    for i, name in enumerate(columns):
        values = []
        for p in probs:
            pair = found.get((f"q{i}", p))
            if pair is None:
                values.append(None)
                continue
            at = (counts[f"q{i}"] - 1) * p
            values.append(pair[0] + (pair[1] - pair[0]) * (at - floor(at)))
        result[name] = values
    return result


def _narrow(base: DataFrame, targets: list[_Target], accuracy: int) -> None:
    """One sketch per column and interval serves all the ranks in it."""
    if not targets:
        return
    shared: dict[tuple, list[_Target]] = {}
    for t in targets:
        shared.setdefault((t.column, t.start, t.stop), []).append(t)
    aggs = []
    for i, group in enumerate(shared.values()):
        probs = []
        for t in group:
            slack = t.slack / accuracy
            probs.append(F.lit(max(0.0, (t.low - t.below) / t.inside - slack)))
            probs.append(F.lit(min(1.0, (t.high - t.below + 1) / t.inside + slack)))
        kept = F.when(group[0].test(), F.col(group[0].column))
        aggs.append(F.percentile_approx(kept, F.array(*probs), F.lit(accuracy)).alias(f"g{i}"))
    row = base.agg(*aggs).first()
    for i, group in enumerate(shared.values()):
        for j, t in enumerate(group):
            t.start, t.stop = row[f"g{i}"][2 * j], row[f"g{i}"][2 * j + 1]


def _measure(base: DataFrame, targets: list[_Target]) -> list[int]:
    aggs = []
    for i, t in enumerate(targets):
        aggs += [
            F.count(F.when(F.col(t.column) < t.start, F.lit(1))).alias(f"b{i}"),
            F.count(F.when(t.test(), F.lit(1))).alias(f"n{i}"),
            F.approx_count_distinct(F.when(t.test(), F.col(t.column))).alias(f"d{i}"),
        ]
    row = base.agg(*aggs).first()
    for i, t in enumerate(targets):
        t.below, t.inside = row[f"b{i}"], row[f"n{i}"]
    return [row[f"d{i}"] for i in range(len(targets))]


def _pick(base: DataFrame, targets: list[_Target]) -> list[tuple[float, float]]:
    """The values at `low` and `high`, from the few distinct values inside each bracket."""
    if not targets:
        return []
    wanted = F.array(*[
        F.when(t.test(), F.struct(F.lit(i).alias("t"), F.col(t.column).alias("v")))
        for i, t in enumerate(targets)
    ])
    inside = reduce(lambda a, b: a | b, [t.test() for t in targets])
    freq = (
        base.filter(inside)
        .select(F.explode(F.filter(wanted, lambda s: s.isNotNull())).alias("s"))
        .groupBy("s.t", "s.v")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    seen = F.sum("n").over(Window.partitionBy("t").orderBy("v"))
    ranked = freq.withColumn("upto", seen)
    low = reduce(lambda acc, it: acc.when(F.col("t") == it[0], it[1].low - it[1].below), enumerate(targets), F)
    high = reduce(lambda acc, it: acc.when(F.col("t") == it[0], it[1].high - it[1].below), enumerate(targets), F)
    rows = (
        ranked.groupBy("t")
        .agg(
            F.min(F.when(F.col("upto") > low, F.col("v"))).alias("low"),
            F.min(F.when(F.col("upto") > high, F.col("v"))).alias("high"),
        )
        .collect()
    )
    by_target = {r["t"]: (r["low"], r["high"]) for r in rows}
    return [by_target[i] for i in range(len(targets))]
