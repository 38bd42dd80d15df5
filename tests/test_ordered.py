"""The cut-up windows give what the plain windows give, on skewed keys and heavy ties."""

import random

import pytest
from pyspark.sql import Window, functions as F

from quayside.operators import ordered as o


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(7)
    data = []
    for i in range(3000):
        key = "hot" if rng.random() < 0.6 else rng.choice(["a", "b", None, "c"])
        v = 5.0 if rng.random() < 0.4 else (None if rng.random() < 0.05 else float(rng.randint(1, 400)))
        x = rng.randint(1, 99) if rng.random() < 0.3 else None
        data.append((i, key, v, x))
    return spark.createDataFrame(data, "id long, k string, v double, x long").repartition(6).cache()


def same(a, b, cols):
    left = sorted(map(tuple, a.select(*cols).collect()), key=repr)
    right = sorted(map(tuple, b.select(*cols).collect()), key=repr)
    assert left == right


KEYS = [[], ["k"]]


@pytest.mark.parametrize("keys", KEYS)
@pytest.mark.parametrize("order", [["v", "id"], ["-v", "id"], ["id"]])
def test_position_and_ntile(rows, keys, order):
    w = Window.partitionBy(*keys).orderBy(*[b.column() for b in o.as_order(order)])
    plain = rows.withColumn("p", F.row_number().over(w).cast("bigint")).withColumn(
        "t", F.ntile(7).over(w).cast("bigint")).withColumn("n", F.count("*").over(Window.partitionBy(*keys)))
    out = o.with_position(rows, order, keys, "p", "n", min_rows=40)
    out = o.with_ntile(out, 7, order, keys, "t", min_rows=40)
    assert set(out.columns) == set(plain.columns)
    same(out, plain, ["id", "p", "t", "n"])


@pytest.mark.parametrize("keys", KEYS)
@pytest.mark.parametrize("by", ["v", "-v"])
def test_ranks(rows, keys, by):
    w = Window.partitionBy(*keys).orderBy(o.as_order(by)[0].column())
    plain = rows.select("id", F.rank().over(w).cast("bigint").alias("r"), F.dense_rank().over(w).cast("bigint").alias("d"),
                        F.percent_rank().over(w).alias("p"))
    out = o.with_rank(rows, by, keys, rank="r", dense="d", percent="p", min_rows=40)
    same(out, plain, ["id", "r", "d", "p"])


@pytest.mark.parametrize("keys", KEYS)
def test_running(rows, keys):
    w = Window.partitionBy(*keys).orderBy(F.col("v").asc_nulls_last(), "id")
    plain = rows.withColumn("s", F.sum("x").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    same(o.with_running(rows, ["v", "id"], {"s": "x"}, keys, min_rows=40), plain, ["id", "s"])
    w = Window.partitionBy(*keys).orderBy(F.col("v").asc_nulls_last())
    plain = rows.withColumn("s", F.sum("x").over(w))
    same(o.with_range_running(rows, "v", {"s": "x"}, keys, min_rows=40), plain, ["id", "s"])


@pytest.mark.parametrize("keys", KEYS)
def test_neighbours(rows, keys):
    def cols(w):
        return {
            "l1": F.lag("id", 1).over(w), "l2": F.lag("x", 2).over(w), "n3": F.lead("id", 3).over(w),
            "m": F.sum("x").over(w.rowsBetween(-4, 2)),
        }

    w = Window.partitionBy(*keys).orderBy(F.col("v").asc_nulls_last(), "id")
    out = o.with_neighbours(rows, ["v", "id"], cols, keys, before=4, after=3, min_rows=40)
    same(out, rows.withColumns(cols(w)), ["id", "l1", "l2", "n3", "m"])


def test_neighbours_longer_than_a_part(rows):
    cols = lambda w: {"m": F.sum("id").over(w.rowsBetween(-100, 0))}
    w = Window.orderBy("id")
    out = o.with_neighbours(rows, "id", cols, before=100, min_rows=20)
    same(out, rows.withColumns(cols(w)), ["id", "m"])


@pytest.mark.parametrize("keys", KEYS)
def test_carry(rows, keys):
    w = Window.partitionBy(*keys).orderBy(F.col("v").asc_nulls_last(), "id")
    plain = rows.withColumns({
        "f": F.last("x", True).over(w.rowsBetween(Window.unboundedPreceding, 0)),
        "b": F.first("x", True).over(w.rowsBetween(0, Window.unboundedFollowing)),
    })
    out = o.with_carry(rows, ["v", "id"], {"f": "x"}, {"b": "x"}, keys, min_rows=40)
    same(out, plain, ["id", "f", "b"])


def test_parts_are_bounded(rows):
    """Heavy ties are cut by the next order column; no part keeps more than a few limits."""
    s = o.split(rows, ["v", "id"], [], min_rows=50)
    assert s.wide
    sizes = [r["count"] for r in s.df.groupBy(o.PART).count().collect()]
    assert max(sizes) <= 150 and sum(sizes) == 3000


def test_small_groups_keep_the_plain_plan(rows):
    s = o.split(rows, ["v", "id"], ["k"], min_rows=10_000)
    assert not s.wide and o.PART not in s.df.columns


def test_back_to_rows_and_top(rows):
    w = Window.partitionBy("k")
    plain = rows.withColumn("m", F.max("x").over(w))
    same(o.back_to_rows(rows, ["k"], F.max("x").alias("m")), plain, ["id", "m"])
    d = rows.dropna(subset=["v"])
    plain = d.withColumn("rank", F.rank().over(Window.orderBy(F.col("v").desc())).cast("bigint")).filter("rank <= 10")
    same(o.top_with_ties(d, "v", 10), plain, ["id", "rank"])


def test_string_and_date_order(rows):
    d = rows.withColumn("s", F.concat_ws("-", "k", F.col("id") % 50)).withColumn("d", F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 400).cast("int")))
    for c in ["s", "d"]:
        w = Window.orderBy(c, "id")
        plain = d.withColumn("p", F.row_number().over(w).cast("bigint"))
        same(o.with_position(d, [c, "id"], name="p", min_rows=50), plain, ["id", "p"])


@pytest.mark.parametrize("keys", KEYS)
@pytest.mark.parametrize("order", [["s", "id"], ["-s", "id"], ["big", "id"], ["dec", "-id"], ["n", "id"], ["-n", "id"]])
def test_orders_that_doubles_cannot_tell_apart(rows, keys, order):
    """Long common prefixes, neighbouring large integers, wide decimals, mostly nulls."""
    far = F.lit(2**60)
    d = rows.withColumns({
        "s": F.concat(F.lit("Customer#0000000"), F.when(F.col("id") % 2 == 0, "").otherwise(F.lpad(((F.col("id") * 7919) % 3000).cast("string"), 5, "0"))),
        "big": far + (F.col("id") * 7919) % 40,
        "dec": (F.lit("9007199254740993.00").cast("decimal(28,2)") + ((F.col("id") * 7919) % 50)).cast("decimal(28,2)"),
        "n": F.when(F.col("id") % 5 == 0, (F.col("id") * 7919) % 100),
    })
    w = Window.partitionBy(*keys).orderBy(*[b.column() for b in o.as_order(order)])
    plain = d.withColumn("p", F.row_number().over(w).cast("bigint"))
    same(o.with_position(d, order, keys, "p", min_rows=40), plain, ["id", "p"])
    first = o.as_order(order)[0]
    w = Window.partitionBy(*keys).orderBy(first.column())
    plain = d.select("id", F.rank().over(w).cast("bigint").alias("r"), F.dense_rank().over(w).cast("bigint").alias("d"))
    same(o.with_rank(d, first, keys, rank="r", dense="d", min_rows=40), plain, ["id", "r", "d"])


def test_empty_input(rows):
    none = rows.filter("id < 0")
    assert o.with_position(none, "id").count() == 0 and o.with_rank(none, "v", ["k"], rank="r").count() == 0
