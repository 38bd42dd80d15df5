"""The saved mart: versions, partitions, and readers."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from quayside.plans import marts as M
from quayside.queries import commerce as C
from quayside.sources import catalog
from quayside.tables import Tables

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def mart(spark):
    t = Tables(spark, FOLDER)
    as_of = F.lit("2001-08-01").cast("date")
    args = (C.customers(t), C.products(t), C.orders(t), C.order_items(t), as_of)
    first = M.publish_mart(*args)
    second = M.publish_mart(*args)
    return first, second


def test_versions(spark, mart):
    first, second = mart
    assert set(first.values()) == {1} and set(second.values()) == {2}
    assert catalog.versions(spark, "mart_fact_orders") == [1, 2]


def test_fact_is_pruned_by_month(spark, mart):
    df = spark.table("mart_fact_orders").filter("order_year = 1997 AND order_month = 7")
    text = df._jdf.queryExecution().executedPlan().toString()
    filters = text.split("PartitionFilters: [")[1].split("]")[0]
    assert "order_year" in filters and "order_month" in filters
    assert df.count() == spark.table("mart_fact_orders").filter(
        F.col("order_date").between(dt.date(1997, 7, 1), dt.date(1997, 7, 31))).count() > 0


def test_saved_results_agree(spark, mart):
    t = Tables(spark, FOLDER)
    lines = t.lineitem.join(t.orders.filter("o_orderstatus = 'F'"), F.col("l_orderkey") == F.col("o_orderkey")).count()
    assert spark.table("mart_fact_orders").count() == lines
    by_day = spark.table("mart_daily_revenue").agg(F.sum("daily_revenue")).first()[0]
    assert spark.table("mart_customer_summary").agg(F.sum("total_revenue")).first()[0] == by_day
    assert spark.table("mart_revenue_by_month_category").agg(F.sum("revenue")).first()[0] == \
        spark.table("mart_fact_orders").agg(F.sum("line_total")).first()[0]


def test_summary_null_order_and_scores(spark):
    day = dt.date
    customers = spark.createDataFrame(
        [(i, f"n{i}", "c", "s", "g", day(2024, 1, 1)) for i in range(1, 6)],
        "customer_id long, customer_name string, city string, state string, customer_segment string, registration_date date")
    orders = spark.createDataFrame(
        [(1, 1, day(2024, 5, 20), "Delivered", "m", 10.0), (2, 1, day(2024, 5, 30), "Delivered", "m", 20.0),
         (3, 2, day(2024, 3, 1), "Delivered", "m", 99.0), (4, 3, day(2024, 5, 1), "Shipped", "m", 50.0)],
        "order_id long, customer_id long, order_date date, order_status string, payment_method string, total_amount double",
    ).withColumn("total_amount", F.col("total_amount").cast("decimal(12,2)"))
    as_of = F.lit("2024-06-01").cast("date")
    got = {r["customer_id"]: r for r in M.customer_summary(customers, orders, as_of).collect()}
    # Customers without delivered orders have no revenue and lead the descending order.
    assert [got[i]["monetary_score"] for i in (3, 4, 5, 2, 1)] == [1, 2, 3, 4, 5]
    assert got[1]["recency_score"] == 5 and got[2]["recency_score"] == 2 and got[3]["recency_score"] == 1
    assert got[1]["total_orders"] == 2 and got[3]["total_orders"] == 0 and got[3]["avg_order_value"] is None
    rfm = {r["customer_id"]: r for r in M.rfm(customers, orders, as_of).collect()}
    assert set(rfm) == {1, 2} and rfm[1]["estimated_clv"] is None
