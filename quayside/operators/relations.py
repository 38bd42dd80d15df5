"""Checks between tables: every table is read once, whatever the number of checks.

Each row of a table says what it is to other rows: a parent or a child under
some key. These statements of all tables are united and counted by key in one
aggregate, where missing partners, repeated keys and wrong totals show together.
Equal statements combine before they move, so a key that a third of all rows
holds weighs no more than others.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

AMOUNT, WHOLE = "decimal(18,4)", ("tinyint", "smallint", "int", "bigint")
MEASURES = ("missing_parent", "without_children", "repeated_keys", "repeated_parts", "wrong_totals", "rows")


@dataclass(frozen=True)
class Role:
    """What the rows of a table are in one relation.

    `key` has the same type on both sides, up to the width of whole numbers. `amount` of a parent should equal
    the sum over its children. `part` tells the children of a key apart, such
    as a line number. A relation may have one side only.
    """

    relation: str
    key: str
    parent: bool = False
    amount: Column | None = None
    part: str | None = None


@dataclass(frozen=True)
class Source:
    """A table, its roles, and conditions of single rows by name."""

    rows: DataFrame
    roles: Sequence[Role] = ()
    bad: dict[str, Column] = field(default_factory=dict)


def _key_type(sources: Sequence[Source]) -> str:
    """One type for all keys: text only where they differ."""
    kinds = {dict(s.rows.dtypes)[r.key] for s in sources for r in s.roles}
    kinds = {"bigint" if k in WHOLE else k for k in kinds}
    return kinds.pop() if len(kinds) == 1 else "string"


def _statements(source: Source, names: list[str], kind: str) -> list[DataFrame]:
    """One row for each role of a row, and for each condition that it meets."""
    no = lambda name: F.lit(names.index(name)).alias("relation")
    amount = lambda a: (F.lit(None) if a is None else a).cast(AMOUNT).alias("amount")
    key = lambda c: c.cast(kind).alias("key")
    plain = [
        F.struct(no(r.relation), key(F.col(r.key)), F.lit(r.parent).alias("parent"), amount(r.amount))
        for r in source.roles if not r.part
    ]
    plain += [
        F.when(bad, F.struct(no(n), key(F.lit(None)), F.lit(True).alias("parent"), amount(None))) for n, bad in source.bad.items()
    ]
    parents, children = F.col("parent").cast("long"), (~F.col("parent")).cast("long")
    out = []
    if plain:
        rows = source.rows.select(F.inline(F.filter(F.array(*plain), lambda x: x.isNotNull())))
        one = F.col("amount")
        out.append(rows.select(
            "relation", "key", parents.alias("parents"), children.alias("children"), F.when(F.col("parent"), one).alias("low"),
            F.when(F.col("parent"), one).alias("high"), F.when(~F.col("parent"), one).cast("decimal(28,4)").alias("total"),
            F.lit(0).cast("long").alias("repeated_parts")))
    for r in (r for r in source.roles if r.part):
        # the parts of a hot key lie spread; each key then comes with a few partial counts
        rows = source.rows.select(no(r.relation), key(F.col(r.key)), F.col(r.part).alias("part"), amount(r.amount))
        rows = rows.groupBy("relation", "key", "part").agg(F.count(F.lit(1)).alias("n"), F.sum("amount").alias("total"))
        none = F.lit(None).cast(AMOUNT)
        out.append(rows.select(
            "relation", "key", F.lit(0).cast("long").alias("parents"), F.col("n").alias("children"), none.alias("low"), none.alias("high"),
            F.col("total").cast("decimal(28,4)").alias("total"),
            (F.col("part").isNotNull() & (F.col("n") > 1)).cast("long").alias("repeated_parts")))
    return out


def relations(sources: Sequence[Source], tolerance: str = "0.01") -> DataFrame:
    """One row per relation and per condition: see `MEASURES`.

    missing_parent: child rows whose key, not null, has no parent;
    without_children: parent rows without a child, null keys included;
    repeated_keys: keys of more than one parent row; repeated_parts: parts of a
    key that more than one child row has; wrong_totals: keys with parents and
    children whose amounts differ by more than `tolerance`; rows: parent rows,
    and for a condition the rows that meet it. Relations without rows are there
    with zeros.
    """
    names = list(dict.fromkeys([r.relation for s in sources for r in s.roles] + [n for s in sources for n in s.bad]))
    kind = _key_type(sources)
    every = reduce(DataFrame.unionByName, [rows for s in sources for rows in _statements(s, names, kind)])
    by_key = every.groupBy("relation", "key").agg(
        *[F.sum(c).alias(c) for c in ("parents", "children")], F.min("low").alias("low"), F.max("high").alias("high"),
        F.sum("total").alias("total"), F.sum("repeated_parts").alias("repeated_parts"))
    parents, children = F.col("parents"), F.col("children")
    off = F.greatest(F.abs(F.col("low") - F.col("total")), F.abs(F.col("high") - F.col("total"))) > F.lit(tolerance).cast("decimal(18,4)")
    count = lambda when, value: F.coalesce(F.sum(F.when(when, value)), F.lit(0)).cast("long")
    figures = by_key.groupBy("relation").agg(
        count(F.col("key").isNotNull() & (parents == 0), children).alias("missing_parent"),
        count(F.col("key").isNull() | (children == 0), parents).alias("without_children"),
        count(parents > 1, F.lit(1)).alias("repeated_keys"),
        F.sum("repeated_parts").alias("repeated_parts"),
        count(F.col("key").isNotNull() & (parents > 0) & (children > 0) & off, F.lit(1)).alias("wrong_totals"),
        F.sum(parents).alias("rows"))
    # one row for each relation: as many as the caller wrote down
    listed = every.sparkSession.createDataFrame(list(enumerate(names)), "_no int, relation_name string")
    out = F.broadcast(listed).join(figures, F.col("_no") == F.col("relation"), "left")
    return out.select(F.col("relation_name").alias("relation"), *[F.coalesce(m, F.lit(0)).alias(m) for m in MEASURES])


def picked(report: DataFrame, wanted: dict[str, tuple[str, str]]) -> DataFrame:
    """issue_type and issue_count: for each name, one measure of one relation."""
    items = F.array(*[
        F.struct(F.lit(relation).alias("_of"), F.lit(name).alias("issue_type"), F.lit(measure).alias("_measure"))
        for name, (relation, measure) in wanted.items()
    ])
    figures = F.create_map(*[x for m in MEASURES for x in (F.lit(m), F.col(m))])
    rows = report.select("relation", figures.alias("_figures"), F.inline(items)).where(F.col("relation") == F.col("_of"))
    return rows.select("issue_type", F.col("_figures")[F.col("_measure")].alias("issue_count"))
