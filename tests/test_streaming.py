"""Streams end where the batch form does, over several batches and after a restart."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from quayside.functions.exact import exact_sum
from quayside.operators import quality as Q
from quayside.plans import marts as M
from quayside.plans.marts import daily_revenue
from quayside.streaming import incremental as I

ORDERS = "order_id long, customer_id long, order_date date, order_status string, total_amount decimal(12,2)"


@pytest.fixture(scope="module")
def orders(spark):
    rows = [
        (i, i % 7, dt.date(2024, 1, 1) + dt.timedelta(days=(i * 37) % 75), "Delivered" if i % 3 else "Shipped", None)
        for i in range(400)
    ]
    return spark.createDataFrame(rows, ORDERS).withColumn("total_amount", (F.col("order_id") * 1.25).cast("decimal(12,2)")).cache()


def parts(df, path, n, start=0):
    """Write `df` as n files, one by one."""
    for i in range(n):
        df.filter(F.col("order_id") % n == i).coalesce(1).write.mode("append").parquet(path)


def test_running_totals(spark, orders, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    parts(orders, src, 4)
    stream = I.arriving_files(spark, src, orders.schema, per_batch=1)
    I.running_totals(stream, out, str(tmp_path / "cp"), exact_sum("total_amount").alias("s"), F.count(F.lit(1)).alias("n"))
    want = orders.agg(exact_sum("total_amount"), F.count(F.lit(1))).first()
    assert tuple(I.latest_totals(spark, out).first()) == tuple(want)
    assert spark.read.parquet(out).select("batch_id").distinct().count() == 4


def rules():
    return Q.RuleSet(errors=[(F.col("total_amount") < 100, "Too small")], required=["order_id"])


def test_quarantine_equals_batch_and_repeats_safely(spark, orders, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    parts(orders, src, 3)
    read = lambda: I.arriving_files(spark, src, orders.schema, per_batch=1)
    I.quarantine(read(), lambda df: Q.check(df, rules()), out, str(tmp_path / "cp"))
    # The same batches again, as after a lost checkpoint: the files are replaced.
    I.quarantine(read(), lambda df: Q.check(df, rules()), out, str(tmp_path / "cp2"))
    saved = spark.read.parquet(out)
    batch = Q.check(orders, rules())
    assert saved.filter("is_valid = 'true'").count() == Q.valid(batch).count()
    assert saved.filter("is_valid = 'false'").count() == Q.invalid(batch).count()


def test_daily_refresh_equals_batch(spark, orders, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    early = orders.filter("order_id < 300")
    parts(early, src, 2)
    read = lambda: I.arriving_files(spark, src, orders.schema, per_batch=1)
    I.refresh_daily(read(), out, str(tmp_path / "cp"))
    rows = lambda df: sorted(map(tuple, df.select(*sorted(df.columns)).collect()))
    assert rows(I.refreshed_daily(spark, out)) == rows(daily_revenue(early))
    # Later files bring orders of days already summed.
    parts(orders.filter("order_id >= 300"), src, 2)
    I.refresh_daily(read(), out, str(tmp_path / "cp"))
    assert rows(I.refreshed_daily(spark, out)) == rows(daily_revenue(orders))


def test_daily_refresh_reads_no_earlier_batch(spark, orders, tmp_path):
    """Its rows depend on the batch alone, folds change nothing, a repeated batch counts once."""
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    parts(orders, src, 4)
    read = lambda: I.arriving_files(spark, src, orders.schema, per_batch=1)
    I.refresh_daily(read(), out, str(tmp_path / "cp"))
    rows = lambda df: sorted(map(tuple, df.select(*sorted(df.columns)).collect()))
    states = spark.read.parquet(f"{out}/state")
    alone = [rows(M.daily_state(orders.filter(F.col("order_id") % 4 == k)).drop("customers")) for k in range(4)]
    left = [rows(states.filter(F.col("batch_id") == i).drop("batch_id", "customers")) for i in range(4)]
    assert sorted(left) == sorted(alone)
    want = rows(daily_revenue(orders))
    assert I.fold_daily(spark, out) == 3 and I.fold_daily(spark, out) == 3
    assert rows(I.refreshed_daily(spark, out)) == want
    I.refresh_daily(read(), out, str(tmp_path / "cp2"))  # all batches again, as after a lost checkpoint
    assert rows(I.refreshed_daily(spark, out)) == want
    late = orders.withColumns({"order_id": F.col("order_id") + 1000, "customer_id": F.col("customer_id") * -40000})
    late.coalesce(1).write.mode("append").parquet(src)
    I.refresh_daily(read(), out, str(tmp_path / "cp2"))
    assert rows(I.refreshed_daily(spark, out)) == rows(daily_revenue(orders.unionByName(late)))
    assert I.fold_daily(spark, out) == 4 and rows(I.refreshed_daily(spark, out)) == rows(daily_revenue(orders.unionByName(late)))


def test_merged_customers_equal_a_distinct_count(spark):
    rows = [(i, (i * 7919 % 200_000) - 90_000 if i % 11 else None, dt.date(2024, 1, 1 + i % 3), "Delivered", None) for i in range(5000)]
    df = spark.createDataFrame(rows, ORDERS).withColumn("total_amount", F.lit(2).cast("decimal(12,2)"))
    pieces = [M.daily_state(df.filter(F.col("order_id") % 4 == k)) for k in (0, 1, 2, 3, 2)]  # one piece twice: sums double, customers don't
    merged = pieces[0]
    for p in pieces[1:]:
        merged = merged.unionByName(p)
    got = {r.order_date: r.unique_customers for r in M.totals_of(M.merged_state(merged)).collect()}
    assert got == {r.order_date: r.unique_customers for r in M.daily_totals(df).collect()}


def test_windowed_counts_drop_repeats_and_late_rows(spark, tmp_path):
    t = lambda h, m: dt.datetime(2025, 1, 1, h, m)
    schema = "ts timestamp, event_id long, kind string, amount double"
    src = str(tmp_path / "in")
    batches = [
        [(t(10, 0), 1, "a", 1.0), (t(10, 5), 2, "a", 2.0), (t(10, 5), 2, "a", 2.0), (t(10, 7), 3, "b", 5.0)],
        [(t(12, 0), 4, "a", 9.0)],
        [(t(10, 30), 5, "a", 100.0), (t(14, 0), 6, "a", 1.0)],
        [(t(16, 0), 7, "a", 1.0)],
    ]
    for b in batches:
        spark.createDataFrame(b, schema).coalesce(1).write.mode("append").parquet(src)
        stream = I.arriving_files(spark, src, spark.createDataFrame([], schema).schema, per_batch=1)
        I.append_files(I.windowed_counts(stream, "ts", "event_id", "kind", "amount"), str(tmp_path / "out"), str(tmp_path / "cp"))
    got = {(r["window_start"].hour, r["kind"]): (r["events"], r["amount"]) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got[10, "a"] == (2, 3.0) and got[10, "b"] == (1, 5.0) and got[12, "a"] == (1, 9.0)
