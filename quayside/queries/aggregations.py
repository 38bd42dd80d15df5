"""Aggregations, sorts and top-k."""

from pyspark.sql import functions as F

from quayside.functions import numbers as N
from quayside.functions.exact import exact_mean, exact_sum, line_total, round_half_up
from quayside.operators.profile import distinct_counts, frequencies, numeric_profile, quantile_table
from quayside.queries.registry import query
from quayside.queries.sqltext import LINE_TOTAL, half_up, mean, money, total


def on(a, b):
    return F.col(a) == F.col(b)


def n_rows(name):
    return F.count(F.lit(1)).alias(name)


@query("a_group_count", """
SELECT n_name AS city, COUNT(*) AS total_customers FROM customer JOIN nation ON c_nationkey = n_nationkey
GROUP BY n_name ORDER BY total_customers DESC
""")
def a_group_count(t):
    """Counted per nation key before the join with the nation names."""
    per = t.customer.groupBy("c_nationkey").agg(n_rows("total_customers"))
    return (
        per.join(t.nation, on("c_nationkey", "n_nationkey"))
        .groupBy(F.col("n_name").alias("city")).agg(F.sum("total_customers").alias("total_customers"))
        .orderBy(F.col("total_customers").desc())
    )


@query("a_group_sum", f"""
SELECT o_orderpriority AS payment_method, {total('o_totalprice')} AS total_revenue
FROM orders GROUP BY o_orderpriority ORDER BY total_revenue DESC
""")
def a_group_sum(t):
    return (
        t.orders.groupBy(F.col("o_orderpriority").alias("payment_method"))
        .agg(exact_sum("o_totalprice").alias("total_revenue"))
        .orderBy(F.col("total_revenue").desc())
    )


@query("a_state_revenue", f"""
SELECT r_name AS state, COUNT(o_orderkey) AS total_orders, {total('o_totalprice')} AS total_revenue,
       {half_up(mean('o_totalprice'))} AS avg_order_value
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey
WHERE o_orderstatus = 'F' GROUP BY r_name ORDER BY total_revenue DESC
""")
def a_state_revenue(t):
    """Orders are summed per customer first: the joins then see one row each."""
    per = t.orders.filter(F.col("o_orderstatus") == "F").groupBy("o_custkey").agg(
        n_rows("n"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("s")
    )
    rows = (
        per.join(t.customer, on("o_custkey", "c_custkey"))
        .join(t.nation, on("c_nationkey", "n_nationkey"))
        .join(t.region, on("n_regionkey", "r_regionkey"))
    )
    out = rows.groupBy(F.col("r_name").alias("state")).agg(F.sum("n").alias("total_orders"), F.sum("s").cast("double").alias("total_revenue"))
    return out.withColumn("avg_order_value", round_half_up(F.col("total_revenue") / F.col("total_orders"))).orderBy(
        F.col("total_revenue").desc()
    )


@query("a_count_distinct", """
SELECT c_mktsegment, COUNT(DISTINCT o_custkey) AS customers, COUNT(o_orderkey) AS orders
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_mktsegment
""")
def a_count_distinct(t):
    """Orders are counted per customer before the join; the distinct count then sees each once."""
    per = t.orders.groupBy("o_custkey").agg(F.count("o_orderkey").alias("n"))
    return per.join(t.customer, on("o_custkey", "c_custkey")).groupBy("c_mktsegment").agg(
        F.count_distinct("o_custkey").alias("customers"), F.sum("n").alias("orders")
    )


@query("a_day_customers", """
SELECT CAST(o_orderdate AS DATE) AS order_date, COUNT(DISTINCT o_custkey) AS customers, COUNT(DISTINCT o_orderpriority) AS methods
FROM orders GROUP BY 1
""")
def a_day_customers(t):
    """Two distinct counts of the raw rows."""
    return distinct_counts(
        t.orders, {"order_date": F.col("o_orderdate").cast("date")}, {"customers": "o_custkey", "methods": "o_orderpriority"})


@query("a_having", f"""
SELECT o_custkey, {total('o_totalprice')} AS total_spent FROM orders WHERE o_orderstatus = 'F'
GROUP BY o_custkey HAVING SUM({money('o_totalprice')}) > 1000000
""")
def a_having(t):
    spent = F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("s")
    return (
        t.orders.filter(F.col("o_orderstatus") == "F").groupBy("o_custkey").agg(spent)
        .filter(F.col("s") > 1000000).select("o_custkey", F.col("s").cast("double").alias("total_spent"))
    )


@query("a_region_revenue", f"""
SELECT l_returnflag AS region, COUNT(*) AS order_count,
       CAST(SUM(CAST(l_quantity AS DECIMAL(6,0)) * CAST(p_retailprice AS DECIMAL(10,2))) AS DOUBLE) AS total_revenue,
       CAST(SUM(CAST(l_quantity AS DECIMAL(6,0)) * CAST(p_retailprice AS DECIMAL(10,2))) AS DOUBLE) / COUNT(*) AS avg_order_value
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_returnflag ORDER BY total_revenue DESC
""")
def a_region_revenue(t):
    """The price depends on the part alone, so quantities are summed per part first."""
    per = t.lineitem.groupBy("l_partkey", "l_returnflag").agg(
        n_rows("n"), F.sum(F.col("l_quantity").cast("decimal(6,0)")).alias("q")
    )
    value = F.col("q") * F.col("p_retailprice").cast("decimal(10,2)")
    out = per.join(t.part, on("l_partkey", "p_partkey")).groupBy(F.col("l_returnflag").alias("region")).agg(
        F.sum("n").alias("order_count"), F.sum(value).cast("double").alias("total_revenue")
    )
    return out.withColumn("avg_order_value", F.col("total_revenue") / F.col("order_count")).orderBy(
        F.col("total_revenue").desc()
    )


@query("a_segment_revenue", f"""
SELECT c_mktsegment AS segment, COUNT(DISTINCT c_custkey) AS customer_count, COUNT(l_orderkey) AS line_count,
       CAST(SUM({LINE_TOTAL}) AS DOUBLE) AS total_revenue
FROM customer LEFT JOIN orders ON c_custkey = o_custkey LEFT JOIN lineitem ON o_orderkey = l_orderkey
GROUP BY c_mktsegment
""")
def a_segment_revenue(t):
    """Lines are summed per order and orders per customer, each before its join."""
    lines = t.lineitem.groupBy("l_orderkey").agg(n_rows("n"), F.sum(line_total()).alias("v"))
    spend = (
        t.orders.select("o_orderkey", "o_custkey").join(lines, on("o_orderkey", "l_orderkey"))
        .groupBy("o_custkey").agg(F.sum("n").alias("n"), F.sum("v").alias("v"))
    )
    rows = t.customer.join(spend, on("c_custkey", "o_custkey"), "left")
    return rows.groupBy(F.col("c_mktsegment").alias("segment")).agg(
        n_rows("customer_count"), F.coalesce(F.sum("n"), F.lit(0)).alias("line_count"),
        F.sum("v").cast("double").alias("total_revenue"),
    )


@query("a_totals", f"""
SELECT CAST(SUM({LINE_TOTAL}) AS DOUBLE) AS total_revenue, {total('l_quantity')} AS total_quantity,
       COUNT(*) AS total_orders, CAST(SUM({LINE_TOTAL}) AS DOUBLE) / COUNT(*) AS avg_order_value
FROM lineitem
""")
def a_totals(t):
    revenue = F.sum(line_total()).cast("double")
    return t.lineitem.agg(
        revenue.alias("total_revenue"), exact_sum("l_quantity").alias("total_quantity"),
        n_rows("total_orders"), (revenue / F.count(F.lit(1))).alias("avg_order_value"),
    )


@query("a_product_summary", f"""
SELECT p_partkey, p_name, {total('l_quantity')} AS quantity, CAST(SUM({LINE_TOTAL}) AS DOUBLE) AS revenue,
       COUNT(*) AS order_count, CAST(SUM({LINE_TOTAL}) AS DOUBLE) / COUNT(*) AS avg_order_value
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_partkey, p_name
""")
def a_product_summary(t):
    per = t.lineitem.groupBy("l_partkey").agg(
        exact_sum("l_quantity").alias("quantity"), F.sum(line_total()).cast("double").alias("revenue"),
        n_rows("order_count"),
    )
    return per.join(t.part, on("l_partkey", "p_partkey")).select(
        "p_partkey", "p_name", "quantity", "revenue", "order_count",
        (F.col("revenue") / F.col("order_count")).alias("avg_order_value"),
    )


@query("a_customer_rollup", f"""
SELECT o_custkey, ARG_MIN(o_orderpriority, (o_orderdate, o_orderkey)) AS first_method,
       CAST(ARG_MIN(o_orderdate, (o_orderdate, o_orderkey)) AS DATE) AS first_date,
       COUNT(*) AS purchase_count, {total('o_totalprice')} AS total_amount, {mean('o_totalprice')} AS avg_amount,
       MAX(o_totalprice) AS max_amount
FROM orders GROUP BY o_custkey
""")
def a_customer_rollup(t):
    first = F.struct("o_orderdate", "o_orderkey")
    return t.orders.groupBy("o_custkey").agg(
        F.min_by("o_orderpriority", first).alias("first_method"),
        F.min_by("o_orderdate", first).cast("date").alias("first_date"),
        n_rows("purchase_count"), exact_sum("o_totalprice").alias("total_amount"),
        exact_mean("o_totalprice").alias("avg_amount"), F.max("o_totalprice").alias("max_amount"),
    )


@query("a_customer_stats", f"""
WITH s AS (
  SELECT o_custkey, COUNT(*) AS purchase_count, SUM(o_totalprice) AS total_spent,
         AVG(o_totalprice) AS avg_purchase, MAX(o_totalprice) AS max_purchase, MIN(o_totalprice) AS min_purchase,
         STDDEV_SAMP(o_totalprice) AS sd FROM orders GROUP BY o_custkey)
SELECT o_custkey, purchase_count, ROUND(total_spent, 2) AS total_spent, ROUND(avg_purchase, 7) AS avg_purchase, max_purchase, min_purchase,
       ROUND(sd, 3) AS purchase_std, max_purchase - min_purchase AS purchase_range,
       ROUND(sd / avg_purchase, 6) AS purchase_cv
FROM s
""")
def a_customer_stats(t):
    from quayside.plans.features import purchase_stats

    return purchase_stats(t.orders, "o_custkey", "o_totalprice").withColumns({
        "purchase_std": F.round("purchase_std", 3), "purchase_cv": F.round("purchase_cv", 6),
        "total_spent": F.round("total_spent", 2), "avg_purchase": F.round("avg_purchase", 7),
    })


PROFILED = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


@query("a_profile", " UNION ALL ".join(f"""
SELECT '{c}' AS feature, COUNT({c}) AS count, MIN({c}) AS min, MAX({c}) AS max, ROUND(AVG({c}), 6) AS mean,
       ROUND(STDDEV_SAMP({c}), 6) AS std, MAX({c}) - MIN({c}) AS range,
       QUANTILE_CONT({c}, 0.25) AS p25, QUANTILE_CONT({c}, 0.5) AS p50, QUANTILE_CONT({c}, 0.75) AS p75 FROM lineitem""" for c in PROFILED))
def a_profile(t):
    return numeric_profile(t.lineitem, PROFILED).withColumns({"std": F.round("std", 6), "mean": F.round("mean", 6)})


@query("a_quantiles", " UNION ALL ".join(
    f"SELECT '{c}' AS feature, CAST({p} AS DOUBLE) AS prob, CAST(QUANTILE_CONT({c}, {p}) AS DOUBLE) AS value FROM lineitem"
    for c in ("l_quantity", "l_extendedprice") for p in (0.25, 0.5, 0.75)))
def a_quantiles(t):
    return quantile_table(t.lineitem, ["l_quantity", "l_extendedprice"], [0.25, 0.5, 0.75])


@query("a_mode", """
SELECT c_mktsegment AS mode_value, COUNT(*) AS n FROM customer GROUP BY c_mktsegment
ORDER BY n DESC, mode_value LIMIT 1
""")
def a_mode(t):
    counts = t.customer.groupBy("c_mktsegment").agg(n_rows("n"))
    best = F.struct(-F.col("n"), F.col("c_mktsegment"))
    return counts.agg(F.min_by("c_mktsegment", best).alias("mode_value"), F.max("n").alias("n"))


@query("a_skew", """
SELECT ROUND(SKEWNESS(l_extendedprice), 6) AS price_skew, ROUND(SKEWNESS(l_quantity), 6) AS quantity_skew FROM lineitem
""")
def a_skew(t):
    return t.lineitem.agg(
        F.round(N.skewness("l_extendedprice"), 6).alias("price_skew"),
        F.round(N.skewness("l_quantity"), 6).alias("quantity_skew"),
    )


@query("a_metrics", f"""
SELECT o_orderstatus, ROUND(SUM(o_totalprice), 2) AS total, ROUND(AVG(o_totalprice), 4) AS average, MIN(o_totalprice) AS min,
       MAX(o_totalprice) AS max, COUNT(o_totalprice) AS count
FROM orders GROUP BY o_orderstatus
""")
def a_metrics(t):
    out = t.orders.groupBy("o_orderstatus").agg(*N.metrics("o_totalprice"))
    return out.withColumns({"total": F.round("total", 2), "average": F.round("average", 4)})


@query("o_sort", "SELECT p_partkey, p_name, p_retailprice FROM part ORDER BY p_retailprice, p_partkey DESC")
def o_sort(t):
    return t.part.select("p_partkey", "p_name", "p_retailprice").orderBy("p_retailprice", F.col("p_partkey").desc())


@query("o_topn", "SELECT p_partkey, p_name, p_retailprice FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 10")
def o_topn(t):
    return t.part.select("p_partkey", "p_name", "p_retailprice").orderBy(F.col("p_retailprice").desc(), "p_partkey").limit(10)


@query("o_multi_key", """
SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders
ORDER BY o_orderpriority, o_totalprice * 0.9 DESC NULLS FIRST, o_orderkey
""")
def o_multi_key(t):
    return t.orders.select("o_orderkey", "o_orderpriority", "o_totalprice").orderBy(
        "o_orderpriority", (F.col("o_totalprice") * 0.9).desc_nulls_first(), "o_orderkey"
    )


@query("o_top_customers", f"""
SELECT o_custkey, {total('o_totalprice')} AS total_spent FROM orders GROUP BY o_custkey
ORDER BY total_spent DESC, o_custkey LIMIT 3
""")
def o_top_customers(t):
    spent = t.orders.groupBy("o_custkey").agg(exact_sum("o_totalprice").alias("total_spent"))
    return spent.orderBy(F.col("total_spent").desc(), "o_custkey").limit(3)


@query("a_frequency", """
SELECT l_returnflag, COUNT(*) AS n, COUNT(*) / CAST((SELECT COUNT(*) FROM lineitem) AS DOUBLE) AS share FROM lineitem GROUP BY l_returnflag
""")
def a_frequency(t):
    return frequencies(t.lineitem, "l_returnflag")


@query("o_limit", "SELECT COUNT(*) AS n FROM (SELECT * FROM customer LIMIT 5)")
def o_limit(t):
    """Which rows a bare limit returns is open, so only their number is compared."""
    return t.customer.limit(5).agg(n_rows("n"))
