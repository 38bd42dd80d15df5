"""The test tables seen as customers, products, orders and order items."""

from pyspark.sql import DataFrame, functions as F

from quayside.functions.exact import line_total


def registrations(t) -> DataFrame:
    """No registration date is stored: the first order stands in for it."""
    return t.orders.groupBy(F.col("o_custkey").alias("customer_id")).agg(
        F.min("o_orderdate").cast("date").alias("registration_date")
    )


def customers(t) -> DataFrame:
    return (
        t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
        .join(registrations(t).withColumnRenamed("customer_id", "_ck"), F.col("c_custkey") == F.col("_ck"), "left")
        .select(
            F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("customer_name"),
            F.col("n_name").alias("city"), F.col("r_name").alias("state"),
            F.col("c_mktsegment").alias("customer_segment"), "registration_date",
        )
    )


def products(t) -> DataFrame:
    price = F.col("p_retailprice").cast("decimal(10,2)")
    return t.part.select(
        F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name"),
        F.col("p_brand").alias("category_name"), price.alias("price"),
        (price * F.lit("0.6").cast("decimal(2,1)")).cast("decimal(10,3)").alias("cost"),
    )


def orders(t) -> DataFrame:
    return t.orders.select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").cast("date").alias("order_date"), F.col("o_orderstatus").alias("order_status"),
        F.col("o_orderpriority").alias("payment_method"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("total_amount"),
    )


def order_items(t) -> DataFrame:
    return t.lineitem.select(
        F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"),
        (F.col("l_discount") * 100).alias("discount_percent"),
        line_total().alias("line_total"),
    )


def as_doubles(df: DataFrame) -> DataFrame:
    """Decimals as doubles, for comparison across engines."""
    return df.select(*[
        F.col(n).cast("double").alias(n) if dtype.startswith("decimal") else F.col(n) for n, dtype in df.dtypes
    ])
