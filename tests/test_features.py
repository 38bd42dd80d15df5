"""The feature run: one exchange of the rows, hot customers in parts."""

import numpy as np
from pyspark.sql import functions as F

from quayside.operators import series as S
from quayside.plans import features as FE

BANDS = ((0, 50, 100), ("Low", "High"))


def purchases(spark, n=2000):
    """Customer 0 has half of the rows, customer 1 gaps, customer 2 one purchase."""
    rows = spark.range(n).select(
        F.col("id"), F.when(F.col("id") % 2 == 0, 0).when(F.col("id") == 7, 2).otherwise(1 + F.col("id") % 40).alias("who"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") * 7919 % 500).cast("int")).alias("day"),
        F.when(F.col("id") % 9 != 1, (F.col("id") * 31 % 997).cast("double")).alias("amount"),
        (F.col("id") % 90).cast("double").alias("base"), F.lit("Some Name").alias("name"),
        F.concat(F.lit("k "), F.col("id") % 3).alias("kind"), F.when(F.col("id") % 5 > 0, F.concat(F.lit("g"), F.col("id") % 4)).alias("grp"))
    return rows.repartition(5)


def run(df, **more):
    return FE.all_features(df, "who", "id", "day", "amount", "base", "name", "kind", "grp", {"g1": 1}, BANDS, "NAME", **more)


def test_equals_the_single_steps(spark):
    df = purchases(spark).cache()
    got = run(df, min_rows=100).toPandas().set_index("id").sort_index()
    stats = FE.purchase_stats(df, "who", "amount").toPandas().set_index("who")
    lags = S.lag_features(df, ["who"], "day", ["day", "id"], "amount").toPandas().set_index("id").sort_index()
    for c in FE.STATS:
        assert np.allclose(got[c].to_numpy(float), stats[c].reindex(got["who"]).to_numpy(float), equal_nan=True), c
    for c in FE.LAGS:
        assert np.allclose(got[c].to_numpy(float), lags[c].to_numpy(float), equal_nan=True), c
    assert len(got) == 2000 and (got["category_k 0"] + got["category_k 1"] + got["category_k 2"] == 1).all()
    assert got["grp_frequency"].isna().sum() == 400


def test_rows_move_once(spark):
    """Shares by group and customer statistics are small; of the rows' exchanges only that by customer is left."""
    df = purchases(spark)
    path = spark.conf.get("spark.checkpoint.dir") + "/features-moved"
    df.write.mode("overwrite").parquet(path)
    out = run(spark.read.parquet(path), levels=["k 0"], min_rows=10**6)
    plan = out._jdf.queryExecution().executedPlan().toString()
    wide = [line for line in plan.splitlines() if "Exchange hashpartitioning(who" in line]
    assert len(wide) == 1 and "SortMergeJoin" not in plan
