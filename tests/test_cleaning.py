"""Fills, outliers, scaling, encoding, narrowing, and the cleaning run."""

import json
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from quayside.operators import dedup as D, encoding as E, missing as M, outliers as O, profile as P, scaling as SC
from quayside.operators.narrowing import column_ranges, narrow
from quayside.plans.cleaning import CleaningConfig, clean

CUSTOMERS = [
    (1, "C001", "Asha", "a@x.com", 28.0, 1200000.0, 5000.0, "Pune"),
    (2, "C002", None, "b@x.com", None, 900000.0, 5000.0, "Mumbai"),
    (3, "C003", "Ravi", None, 35.0, None, None, ""),
    (4, "C004", "", "d@x.com", 42.0, 1500000.0, 7000.0, "Pune"),
    (5, "C005", "Mina", "", None, 800000.0, None, None),
    (6, None, None, None, None, None, None, None),
]
SCHEMA = "row_no int, customer_id string, name string, email string, age double, salary double, amount double, city string"


@pytest.fixture(scope="module")
def customers(spark):
    return spark.createDataFrame(CUSTOMERS, SCHEMA).cache()


def column(df, name, key="row_no"):
    return [r[name] for r in df.orderBy(key).collect()]


def test_fill_strategies(customers):
    values = M.learn_fill(customers, {"age": "mean", "salary": "median", "amount": "mode", "city": "mode", "name": "const:Unknown Customer"})
    assert values == {"age": 35.0, "salary": 1050000.0, "amount": 5000.0, "city": "Pune", "name": "Unknown Customer"}
    out = M.fill(customers, values)
    assert column(out, "age") == [28.0, 35.0, 35.0, 42.0, 35.0, 35.0]
    assert column(out, "city") == ["Pune", "Mumbai", "", "Pune", "Pune", "Pune"]
    assert column(out, "name")[3] == ""
    with pytest.raises(ValueError):
        M.learn_fill(customers, {"age": "guess"})


def test_modes_of_many_columns(spark):
    """Against one count for each column; a sketch first changes nothing."""
    rng = random.Random(2)
    rows = [(rng.choice(["b", "a", None]), rng.randrange(4), rng.choice([0.5, 1.5]), f"own {i}", None, i % 2 == 0, i) for i in range(600)]
    df = spark.createDataFrame(rows, "s string, i int, f double, u string, n string, b boolean, id long").repartition(3)
    want = {}
    for at, c in enumerate(df.columns):
        known = [r[at] for r in rows if r[at] is not None]
        want[c] = min(known, key=lambda v: (-known.count(v), v)) if known else None
    assert P.modes(df, df.columns) == want
    for support in (0.3, 0.05, 0.001):
        assert P.modes(df, df.columns, support) == want
    assert P.modes(df.limit(0), ["s"], 0.1) == {"s": None} and P.modes(df, []) == {}


def test_modes_in_one_job(spark):
    df = spark.range(100).select(*[(F.col("id") % k).cast("string").alias(f"c{k}") for k in range(2, 9)])
    jobs = []
    for columns in (["c2"], df.columns):
        spark.sparkContext.setJobGroup(f"modes-{len(columns)}", "")
        P.modes(df, columns)
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"modes-{len(columns)}")))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs[0] == jobs[1]


def test_distinct_counts(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, "a", 2), (1, None, 2), (2, None, None), (None, "z", 5)], "k int, s string, i int")
    got = P.distinct_counts(df, {"k": F.col("k")}, {"s_n": "s", "i_n": "i"})
    assert sorted(map(tuple, got.collect()), key=repr) == [(1, 1, 2), (2, 0, 0), (None, 1, 1)]
    assert "Expand" not in got._jdf.queryExecution().executedPlan().toString()


def test_mode_without_values(spark):
    df = spark.createDataFrame([(1, None)], "a int, s string")
    assert M.learn_fill(df, {"s": "mode"}) == {"s": "Unknown"}
    assert P.mode_value(df, "s") is None


def test_drops(customers):
    assert M.drop_rows(customers).count() == 2
    assert M.drop_rows(customers, "all", ["customer_id", "name", "email"]).count() == 5
    assert M.drop_rows(customers, subset=["name", "email"]).count() == 3
    slim = M.drop_sparse_columns(customers.select("row_no", F.when(F.col("row_no") == 1, 1).alias("rare")))
    assert slim.columns == ["row_no"]


def test_missing_profile(customers):
    got = {r["column_name"]: (r["missing_count"], round(r["missing_pct"], 2)) for r in P.missing_profile(customers).collect()}
    assert got["age"] == (3, 50.0) and got["row_no"] == (0, 0.0)


def test_quality_profile_counts_copies(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, None), (1, None), (2, None)], "a int, b string")
    assert tuple(P.quality_profile(df).first()) == (5, 2, 3, 30.0, 2)


@pytest.fixture(scope="module")
def values(spark):
    rng = random.Random(1)
    data = [(i, rng.gauss(50000, 15000)) for i in range(95)] + [(95 + i, v) for i, v in enumerate((250000.0, 300000.0, -50000.0, 400000.0))] + [(99, None)]
    return spark.createDataFrame(data, "id int, v double").cache()


def test_outliers_match_pandas(values):
    v = pd.Series([r["v"] for r in values.collect()], dtype=float)
    q1, q3 = v.quantile(0.25), v.quantile(0.75)
    lo, hi = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
    bounds = O.iqr_bounds(values, ["v"])["v"]
    assert bounds == pytest.approx((lo, hi))
    assert O.iqr_outliers(values, "v").count() == int(((v < lo) | (v > hi)).sum())
    z = np.abs((v - v.mean()) / v.std(ddof=0))
    assert O.zscore_outliers(values, "v").count() == int((z > 3).sum())
    kept = O.remove_outliers(values, "v", bounds)
    assert kept.count() == int(v.between(lo, hi).sum())
    capped = O.cap_outliers(values, {"v": bounds})
    row = capped.agg(F.min("v"), F.max("v"), F.count("v")).first()
    assert row[0] >= lo and row[1] <= hi and row[2] == 99
    table = {r["method"]: r for r in O.compare_strategies(values.filter("v > 0"), "v").collect()}
    p = v[v > 0]
    assert table["Original"]["std"] == pytest.approx(p.std()) and table["Original"]["skew"] == pytest.approx(p.skew())
    assert table["Log Transformed"]["mean"] == pytest.approx(np.log1p(p).mean())


def test_column_without_values(spark):
    """As pandas: no outlier rows, figures that are not numbers."""
    df = spark.createDataFrame([(1, None, 2.0), (2, None, 3.0)], "id int, v double, w double")
    out = O.iqr_outliers(df, "v")
    assert out.columns == ["id", "v", "w", "lower_bound", "upper_bound"] and out.count() == 0
    assert O.zscore_outliers(df, "v").count() == 0
    assert O.remove_outliers(df, "v", O.iqr_bounds(df, ["v"]).get("v")).count() == 0
    for table in (O.compare_strategies(df, "v"), SC.compare_scalings(df, "v")):
        rows = table.collect()
        assert len(rows) == 4 and all(r["mean"] is None and r["min"] is None for r in rows)
    assert SC.scale(df, ["v", "w"], "minmax").select("w").collect()[0][0] == 0.0
    assert SC.compare_scalings(df.limit(0), "w").count() == 4


def test_scaling_properties(values):
    rows = values.filter("v is not null").withColumn("c", F.lit(7))
    for method in ("standard", "minmax", "robust"):
        assert {r["c"] for r in SC.scale(rows, ["c"], method).select("c").distinct().collect()} == {0.0}
    z = SC.scale(rows, ["v"], "standard").agg(F.avg("v"), F.stddev_pop("v")).first()
    assert z[0] == pytest.approx(0, abs=1e-9) and z[1] == pytest.approx(1)
    m = SC.scale(rows, ["v"], "minmax").agg(F.min("v"), F.max("v")).first()
    assert tuple(m) == (0.0, 1.0)
    r = SC.scale(rows, ["v"], "robust").agg(F.median("v")).first()[0]
    assert r == pytest.approx(0, abs=1e-12)
    names = {x["method"] for x in SC.compare_scalings(rows, "v").collect()}
    assert names == {"Original", "Standardized", "Normalized", "Robust"}


def test_encoding(spark):
    df = spark.createDataFrame([(1, "A b"), (2, "C"), (3, None), (4, "C")], "i int, s string")
    hot = E.one_hot(df, "s", "p")
    assert hot.columns == ["i", "p_A b", "p_C"]
    assert [tuple(r) for r in hot.orderBy("i").collect()] == [(1, 1, 0), (2, 0, 1), (3, 0, 0), (4, 0, 1)]
    freq = {r["i"]: r["f"] for r in E.frequency_encode(df, "s", "f").collect()}
    assert freq == {1: pytest.approx(1 / 3), 2: pytest.approx(2 / 3), 3: None, 4: pytest.approx(2 / 3)}


def test_one_hot_keeps_levels_with_like_names(spark):
    """As pandas.get_dummies does, up to the numbers behind names that differ by case only."""
    rows = [(i, s) for i, s in enumerate(["a b", "a_b", "a-b", "c", "C", "x.y", "x`y", None, "a b"])]
    df = spark.createDataFrame(rows, "i int, s string").withColumn("x_c", F.lit(9))
    hot = E.one_hot(df, "s", "x").orderBy("i")
    levels = ["C", "a b", "a-b", "a_b", "c", "x.y", "x`y"]
    assert hot.columns == ["i", "x_c", "x_C_2", "x_a b", "x_a-b", "x_a_b", "x_c_3", "x_x.y", "x_x`y"]
    want = pd.get_dummies(pd.Series([s for _, s in rows]), dtype=int)[levels].to_numpy()
    assert (hot.drop("i", "x_c").toPandas().to_numpy() == want).all()
    numbers = spark.createDataFrame([(1.5,), (2.0,)], "n double")
    assert E.one_hot(numbers, "n").columns == ["n_1.5", "n_2.0"]


def test_level_count_changes_no_form(spark):
    for n in (3, 1001):
        df = spark.range(n).select("id", F.format_string("v%05d", "id").alias("s"))
        hot = E.one_hot(df, "s")
        assert hot.columns == ["id", *[f"s_v{i:05d}" for i in range(n)]]
        vector = E.one_hot_vector(df, "s", E.level_table(df, "s", min_rows=200), "hot")
        assert vector.dtypes[-1] == ("hot", "struct<size:bigint,indices:array<bigint>,values:array<int>>")
        assert [(r.hot.size, r.hot.indices, r.hot["values"]) for r in vector.orderBy("id").collect()] == [(n, [i], [1]) for i in range(n)]
    assert sum(hot.first()[1:]) == 1


def test_vector_of_unknown_and_null(spark):
    known = spark.createDataFrame([("b",), ("a",), ("b",), (None,)], "s string")
    df = spark.createDataFrame([(1, "b"), (2, "z"), (3, None), (4, "a")], "i int, s string")
    levels = E.level_table(known, "s")
    assert sorted(map(tuple, levels.collect())) == [("a", 0), ("b", 1)]
    out = E.one_hot_vector(df, "s", levels, "hot").orderBy("i").collect()
    assert [(r.hot.size, r.hot.indices) for r in out] == [(2, [1]), (2, []), (2, []), (2, [0])]
    assert E.one_hot_vector(df, "s", levels.limit(0), "hot").first().hot.size == 0


def test_narrowing(spark):
    df = spark.createDataFrame([(1, 300, 2**40, 1.5, "a"), (100, -5, 3, 2.5, "a"), (7, 0, 0, None, "a")], "a long, b long, c long, d double, s string")
    assert dict(narrow(df).dtypes) == {"a": "tinyint", "b": "smallint", "c": "bigint", "d": "float", "s": "string"}
    got = {r["column_name"]: (r["narrow_type"], r["low_cardinality"]) for r in column_ranges(df).collect()}
    assert got == {"a": ("tinyint", None), "b": ("smallint", None), "c": ("bigint", None), "d": ("float", None), "s": ("string", True)}


DUPS = [
    (1, "C001", "Asha Rao", "a@x.com", 100), (2, "C002", "Ravi", "R@x.com", 200), (3, "C001", "Asha Rao", "a@x.com", 100),
    (4, "C003", "Mina", "m@x.com", 300), (5, "C002", "RAVI ", "r@x.com", 250), (6, "C004", None, None, 10), (7, "C004", None, None, 10),
]


def test_dedup(spark):
    df = spark.createDataFrame(DUPS, "id int, customer_id string, name string, email string, amount int").repartition(3)
    cols = ["customer_id", "name", "email", "amount"]
    ids = lambda d: sorted(r["id"] for r in d.collect())
    assert ids(D.keep_one(df, cols, "id")) == [1, 2, 4, 5, 6]
    assert ids(D.keep_one(df, cols, "id", "last")) == [2, 3, 4, 5, 7]
    assert ids(D.keep_one(df, cols, "id", "none")) == [2, 4, 5]
    assert ids(D.keep_one(df, [F.lower("email")], "id")) == [1, 2, 4, 6]
    assert ids(D.distinct_by(df, ["customer_id"], ["id"])) == [1, 2, 4, 6]
    assert ids(D.repeated(df, cols)) == [1, 3, 6, 7]
    assert ids(D.name_variants(df.withColumn("name", F.when(F.col("id") == 5, "Raveena").otherwise(F.col("name"))), "customer_id", "name")) == [2, 5]
    assert D.name_variants(df, "customer_id", "name").count() == 0
    once = D.keep_one(df, cols, "id")
    assert ids(D.keep_one(once, cols, "id")) == ids(once)
    got = {r["kind"]: r["duplicates"] for r in D.duplicate_profile(df, {"exact": cols, "id": ["customer_id"], "combo": ["customer_id", "amount"]}).collect()}
    assert got == {"exact": 2, "id": 3, "combo": 2}


def production(n=200):
    rng = random.Random(5)
    rows = []
    for i in range(n):
        rows.append((f"C{i:04d}", rng.choice([" asha rao", "RAVI", None]), rng.choice([" A@X.COM ", None, "b@x.com"]),
                     rng.choice(["+91-9876543210", "98765"]), rng.choice([25.0, 30.0, None, 200.0]),
                     rng.gauss(1e6, 2e5) if rng.random() > 0.1 else 9e6, i % 7))
    rows += rows[:20]
    return [(i, *r) for i, r in enumerate(rows)]


def test_cleaning_run(spark):
    schema = "row_no long, customer_id string, name string, email string, phone string, age double, salary double, visits long"
    df = spark.createDataFrame(production(), schema).repartition(4)
    out, report = clean(df, "row_no")
    steps = {s: d for s, d in report.steps}
    assert [s for s, _ in report.steps] == [
        "analyze_quality", "handle_missing", "remove_duplicates", "handle_outliers", "clean_text", "optimize_types", "final"]
    assert steps["remove_duplicates"] == {"before": 220, "after": 200, "removed": 20}
    assert steps["handle_missing"]["after"] == 0 and steps["handle_missing"]["filled"] == steps["analyze_quality"]["missing_values"]
    assert steps["final"]["total_rows"] == 200 and steps["final"]["missing_values"] == 0 and steps["final"]["duplicate_rows"] == 0
    assert set(steps["handle_outliers"]) >= {"salary"}
    assert dict(out.dtypes)["visits"] == "tinyint" and dict(out.dtypes)["salary"] == "float"
    assert {r["name"] for r in out.select("name").distinct().collect()} == {"Asha Rao", "Ravi"}
    assert {r["phone"] for r in out.select("phone").distinct().collect()} == {"919876543210", "98765"}

    pdf = pd.DataFrame(production(), columns=df.columns).drop(columns="row_no")
    for c in ("age", "salary", "visits"):
        pdf[c] = pdf[c].fillna(pdf[c].median())
    for c in ("name", "email"):
        pdf[c] = pdf[c].fillna(pdf[c].mode()[0])
    pdf = pdf.drop_duplicates()
    for c in ("age", "salary", "visits"):
        q1, q3 = pdf[c].quantile(0.25), pdf[c].quantile(0.75)
        pdf[c] = pdf[c].clip(q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1))
    got = out.orderBy("row_no").toPandas()
    assert np.allclose(got["salary"], pdf["salary"], rtol=1e-6) and np.allclose(got["age"], pdf["age"])
    frame = report.frame(spark).orderBy("step_no").collect()
    assert json.loads(frame[2]["details"])["removed"] == 20


def test_cleaning_options(spark):
    df = spark.createDataFrame([(1, "a", None), (2, "a", 5.0), (3, "b", 7.0)], "row_no long, s string, v double")
    out, _ = clean(df, "row_no", CleaningConfig(numeric_strategy="mean", dedup_subset=["s"], keep="last"))
    assert sorted((r["row_no"], r["v"]) for r in out.collect()) == [(2, 5.0), (3, 7.0)]
