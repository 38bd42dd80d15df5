"""Sums and means keep their digits; long texts, wide frames, big baskets and trees keep their plan."""

import random

import pytest
from pyspark.sql import Window, functions as F

from quayside.functions import exact, numbers as N
from quayside.operators import hierarchy, missing as M, ordered as O, series as S
from quayside.operators.pairs import frequent_pairs
from quayside.operators.profile import numeric_profile
from quayside.session import scratch_path


def test_small_digits_and_large_values(spark):
    df = spark.createDataFrame([(1, 0.001), (2, 0.002), (3, 0.004)], "i int, v double")
    assert M.learn_fill(df, {"v": "mean"})["v"] == pytest.approx(0.007 / 3)
    total, average, *_ = df.agg(*N.metrics("v")).first()
    assert (total, average) == (pytest.approx(0.007), pytest.approx(0.007 / 3))
    got = S.moving_average(df.withColumn("v", F.col("v") / 100), "i", "v", 2, "m").orderBy("i").collect()
    assert [r["m"] for r in got] == pytest.approx([0.00001, 0.000015, 0.00003])
    large = spark.createDataFrame([(1, 1e17), (2, 3e17)], "i int, v double")
    assert large.agg(*N.metrics("v")).first()["total"] == 4e17
    assert M.learn_fill(large, {"v": "mean"}) == {"v": 2e17}
    assert [r["m"] for r in S.moving_average(large, "i", "v", 2, "m").orderBy("i").collect()] == [1e17, 2e17]


def test_rounding_once(spark):
    row = spark.range(1).select(exact.round_half_up(F.lit(1.0049999996)).alias("a"), exact.round_half_up(F.lit(1.005)).alias("b")).first()
    assert tuple(row) == (1.0, 1.01)


def test_profile_quartiles(spark):
    df = spark.createDataFrame([(0.00001 * i, None) for i in range(1, 6)], "a double, b double")
    rows = {r["feature"]: r for r in numeric_profile(df, ["a", "b"]).collect()}
    assert [rows["a"][c] for c in ("mean", "p25", "p50", "p75")] == pytest.approx([0.00003, 0.00002, 0.00003, 0.00004])
    assert rows["b"]["count"] == 0 and rows["b"]["p50"] is None and rows["b"]["mean"] is None


def texts(n: int) -> list:
    rng = random.Random(4)
    start = "https://www.example.org/a/very/long/common/beginning/"
    out = [start + "page/%06d" % rng.randrange(n) for _ in range(n)] + [start + "same"] * n + ["", "a", "a\x00", "a\x00b", None, None]
    return [(i, v) for i, v in enumerate(out)]


@pytest.mark.parametrize("desc", [False, True])
def test_texts_with_a_common_beginning_are_split(spark, desc):
    rows = texts(3000)
    df = spark.createDataFrame(rows, "i int, s string").repartition(4)
    order = [O.By("s", desc), O.By("i")]
    s = O.split(df, order, min_rows=50)
    sizes = [r["count"] for r in s.df.groupBy(O.PART).count().collect()]
    assert len(sizes) > 30 and max(sizes) < 600
    got = {r["i"]: r["n"] for r in O.with_position(df, order, name="n", min_rows=50).collect()}
    first = df.select("i", F.row_number().over(Window.orderBy(*[o.column() for o in order])).alias("n"))
    assert got == {r["i"]: r["n"] for r in first.collect()}


def test_ranks_of_texts_with_a_common_beginning(spark):
    df = spark.createDataFrame([(i, i % 2, v) for i, v in texts(1500)], "i int, k int, s string").repartition(4)
    for keys in ([], ["k"]):
        w = Window.partitionBy(*keys).orderBy(F.col("s").asc_nulls_last())
        want = df.select("i", F.rank().over(w), F.dense_rank().over(w)).collect()
        got = O.with_rank(df, "s", keys, rank="r", dense="d", min_rows=20).select("i", "r", "d").collect()
        assert sorted(map(tuple, got)) == sorted(map(tuple, want))


@pytest.mark.parametrize("keys", [[], ["k"]])
def test_wide_frames_over_many_parts(spark, keys):
    rng = random.Random(7)
    rows = [(i, 0 if rng.random() < 0.8 else rng.randrange(1, 40), float(rng.randrange(1000))) for i in range(4000)]
    df = spark.createDataFrame(rows, "i int, k int, v double").repartition(4)

    def columns(w):
        return {"back": F.sum("v").over(w.rowsBetween(-150, 0)), "ahead": F.sum("v").over(w.rowsBetween(0, 90)), "next": F.lead("v", 90).over(w)}

    w = Window.partitionBy(*keys).orderBy("i")
    want = df.withColumns(columns(w)).collect()
    got = O.with_neighbours(df, "i", columns, keys, before=150, after=90, min_rows=20)
    assert sorted(map(tuple, got.select(df.columns + ["back", "ahead", "next"]).collect())) == sorted(map(tuple, want))


def test_joins_of_pairs_do_not_grow_with_support(spark):
    rng = random.Random(3)
    held = {(b, i) for b in range(12) for i in range(60) if rng.random() < 0.7} | {(b, rng.randrange(60)) for b in range(12, 400) for _ in range(4)}
    df = spark.createDataFrame(sorted(held), "b int, i int")
    plans = []
    for support in (3, 9):
        out = frequent_pairs(df, "b", "i", support, big_basket=10)
        baskets: dict = {}
        for b, i in held:
            baskets.setdefault(b, set()).add(i)
        count: dict = {}
        for items in baskets.values():
            for x in items:
                for y in items:
                    if x < y:
                        count[x, y] = count.get((x, y), 0) + 1
        assert {(r["item_a"], r["item_b"]): r["support"] for r in out.collect()} == {p: n for p, n in count.items() if n >= support}
        plans.append(out._jdf.queryExecution().optimizedPlan().toString().count("Join"))
    assert plans[0] == plans[1]


def test_deep_trees_and_cycles(spark):
    depth = 12
    nodes = [(0, None, "n0")] + [(i, i - 1, f"n{i}") for i in range(1, depth)]
    nodes += [(0, depth - 1, "n0 again"), (50, 51, "x"), (51, 50, "y")]
    out = hierarchy.tree(spark.createDataFrame(nodes, "id int, parent int, name string"), "id", "parent", "name", ">").collect()
    assert sorted(r["id"] for r in out) == list(range(depth))
    assert max(out, key=lambda r: r["level"])["full_path"] == ">".join(f"n{i}" for i in range(depth))
    assert hierarchy.tree(spark.createDataFrame([], "id int, parent int, name string"), "id", "parent", "name").count() == 0


def test_a_chain_takes_few_rounds(spark, monkeypatch):
    """Pointer doubling: 1,000 nodes in a row within 12 rounds, each written once."""
    paths = []
    monkeypatch.setattr(hierarchy, "scratch_path", lambda s, n: paths.append(scratch_path(s, n)) or paths[-1])
    rows = spark.range(1000).select(F.col("id"), F.when(F.col("id") > 0, F.col("id") - 1).alias("up"), F.concat(F.lit("n"), "id").alias("name"))
    out = hierarchy.tree(rows, "id", "up", "name", ">")
    assert out.agg(F.sum("level"), F.max("level"), F.count(F.lit(1))).first()[:] == (499500, 999, 1000)
    assert out.where("level = 999").first()["full_path"] == ">".join(f"n{i}" for i in range(1000))
    assert spark.read.parquet(paths[0]).select("round").distinct().count() <= 12


def test_random_trees(spark):
    """Several parents, orphans, cycles below a root and apart, against a walk."""
    rng = random.Random(8)
    for repeated in (False, True):
        nodes = [(i, rng.choice([None, *range(max(0, i - 4), i)]) if i % 9 else None, f"n{i}") for i in range(60)]
        nodes += [(100, 999, "orphan"), (200, 201, "c"), (201, 200, "d"), (202, 201, "below"), (None, 3, "no id")]
        if repeated:
            nodes += [(7, 12, "n7"), (3, 20, "n3"), (0, 30, "n0"), (300, None, "r"), (300, None, "r")]
        want, level = [], [(i, n, n, 0, (i,)) for i, p, n in nodes if p is None]
        while level:
            want += [("  " * d + n, path, d) for _, n, path, d, _ in level]
            level = [(c, n, f"{path} > {n}", d + 1, (*seen, c)) for i, _, path, d, seen in level for c, p, n in nodes if p == i and c not in seen and i is not None]
        df = spark.createDataFrame(nodes, "id int, up int, name string")
        got = [(r.indented_name, r.full_path, r.level) for r in hierarchy.tree(df, "id", "up", "name").collect()]
        assert sorted(got) == sorted(want), repeated
