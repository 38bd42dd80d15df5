"""Checking sales records and measuring the good ones."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from quayside.functions import numbers, rules

# Revenue above this gets the discount, in percent.
HIGH_REVENUE = 100_000
HIGH_DISCOUNT = 10


def process_sales(df: DataFrame, price_max: float = 1_000_000) -> DataFrame:
    """Field rules on price, quantity and customer_id, then revenue and discount of valid records."""
    verdicts = [
        rules.price("price", 0, price_max),
        rules.quantity("quantity"),
        rules.customer_id("customer_id"),
    ]
    errors = F.array_compact(F.array(*[v["error"] for v in verdicts]))
    out = df.withColumn("errors", errors).withColumn("valid", F.size("errors") == 0)
    revenue = F.when(F.col("valid"), numbers.revenue("price", "quantity"))
    out = out.withColumn("revenue", revenue)
    off = numbers.discount("revenue", F.lit(HIGH_DISCOUNT))
    high = F.col("revenue") > HIGH_REVENUE
    return out.withColumns({
        "discount_applied": high,
        "discount_amount": F.when(high, off["amount"]),
        "final_revenue": F.when(high, off["price"]).otherwise(F.col("revenue")),
    })


def sales_totals(processed: DataFrame) -> DataFrame:
    n = F.count(F.lit(1))
    good = F.count(F.when(F.col("valid"), F.lit(1)))
    return processed.agg(
        n.alias("total_records"), good.alias("valid_records"), (n - good).alias("invalid_records"),
        F.try_divide(good.cast("double"), n).alias("valid_share"),
        F.coalesce(F.sum("final_revenue"), F.lit(0.0)).alias("total_revenue"),
    )
