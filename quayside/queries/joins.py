"""Joins. Strategies are left to the planner, which broadcasts a side only when
its measured size is under the session's threshold and splits skewed keys."""

from pyspark.sql import functions as F

from quayside.functions.exact import exact_sum, line_total
from quayside.operators.ordered import back_to_rows
from quayside.operators.pairs import every_combination, frequent_pairs
from quayside.operators.quality import unmatched
from quayside.queries.registry import query
from quayside.queries.sqltext import LINE_TOTAL, mean


def on(a, b):
    return F.col(a) == F.col(b)


@query("j_inner", """
SELECT c_custkey, c_name, o_orderkey, o_totalprice FROM customer JOIN orders ON c_custkey = o_custkey
""")
def j_inner(t):
    return t.customer.join(t.orders, on("c_custkey", "o_custkey")).select(
        "c_custkey", "c_name", "o_orderkey", "o_totalprice"
    )


@query("j_left", """
SELECT c_custkey, c_name, o_orderkey, CAST(o_orderdate AS DATE) AS order_date
FROM customer LEFT JOIN orders ON c_custkey = o_custkey
""")
def j_left(t):
    return t.customer.join(t.orders, on("c_custkey", "o_custkey"), "left").select(
        "c_custkey", "c_name", "o_orderkey", F.col("o_orderdate").cast("date").alias("order_date")
    )


@query("j_star4", """
SELECT c_name AS customer_name, p_name AS product_name, l_quantity AS quantity,
       l_extendedprice / l_quantity AS unit_price, CAST(o_orderdate AS DATE) AS order_date,
       o_orderkey, l_linenumber
FROM orders JOIN lineitem ON o_orderkey = l_orderkey JOIN part ON l_partkey = p_partkey
JOIN customer ON o_custkey = c_custkey
WHERE o_orderstatus = 'F'
""")
def j_star4(t):
    return (
        t.orders.filter(F.col("o_orderstatus") == "F")
        .join(t.lineitem, on("o_orderkey", "l_orderkey"))
        .join(t.part, on("l_partkey", "p_partkey"))
        .join(t.customer, on("o_custkey", "c_custkey"))
        .select(
            F.col("c_name").alias("customer_name"), F.col("p_name").alias("product_name"),
            F.col("l_quantity").alias("quantity"),
            (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"),
            F.col("o_orderdate").cast("date").alias("order_date"), "o_orderkey", "l_linenumber",
        )
    )


@query("j_left_on_pred", """
SELECT c_custkey, c_mktsegment, o_orderkey, o_totalprice
FROM customer LEFT JOIN orders ON c_custkey = o_custkey AND o_orderstatus = 'F'
""")
def j_left_on_pred(t):
    delivered = t.orders.filter(F.col("o_orderstatus") == "F")
    return t.customer.join(delivered, on("c_custkey", "o_custkey"), "left").select(
        "c_custkey", "c_mktsegment", "o_orderkey", "o_totalprice"
    )


@query("j_left_chain", f"""
SELECT c_custkey, o_orderkey, p_name, l_quantity
FROM customer
LEFT JOIN orders ON c_custkey = o_custkey
LEFT JOIN lineitem ON o_orderkey = l_orderkey
LEFT JOIN part ON l_partkey = p_partkey
""")
def j_left_chain(t):
    return (
        t.customer.join(t.orders, on("c_custkey", "o_custkey"), "left")
        .join(t.lineitem, on("o_orderkey", "l_orderkey"), "left")
        .join(t.part, on("l_partkey", "p_partkey"), "left")
        .select("c_custkey", "o_orderkey", "p_name", "l_quantity")
    )


@query("j_anti", """
SELECT o_orderkey, o_custkey FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey WHERE l_orderkey IS NULL
""")
def j_anti(t):
    return unmatched(t.orders, "o_orderkey", t.lineitem, "l_orderkey").select("o_orderkey", "o_custkey")


@query("j_semi_above_avg", f"""
SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE c_custkey IN (
  SELECT o_custkey FROM orders GROUP BY o_custkey
  HAVING {mean('o_totalprice')} > (SELECT {mean('o_totalprice')} FROM orders))
""")
def j_semi_above_avg(t):
    # Sum and count per customer first; the overall mean comes from those partial sums.
    per = t.orders.groupBy("o_custkey").agg(
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("s"), F.count("o_totalprice").alias("n")
    )
    overall = per.agg((F.sum("s").cast("double") / F.sum("n")).alias("m")).scalar()
    above = per.filter(F.col("s").cast("double") / F.col("n") > overall)
    return t.customer.join(above, on("c_custkey", "o_custkey"), "left_semi").select(
        "c_custkey", "c_name", "c_mktsegment"
    )


@query("j_corr_count", """
SELECT c_custkey, c_name, (SELECT COUNT(*) FROM orders WHERE o_custkey = c_custkey) AS order_count FROM customer
""")
def j_corr_count(t):
    """Counted per customer before the join, so a hot customer's orders never cross it."""
    counts = t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    return t.customer.join(counts, on("c_custkey", "o_custkey"), "left").select(
        "c_custkey", "c_name", F.coalesce("n", F.lit(0)).alias("order_count")
    )


@query("j_corr_count_sql", """
SELECT c_custkey, c_name, COUNT(o_orderkey) AS order_count
FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey, c_name
""")
def j_corr_count_sql(t):
    """The correlated form as SQL text; the optimizer turns it into an aggregate and a join."""
    t.register("customer", "orders")
    return t.spark.sql(
        "SELECT c_custkey, c_name, (SELECT COUNT(*) FROM orders WHERE o_custkey = c_custkey) AS order_count FROM customer"
    )


@query("j_total_mismatch", f"""
SELECT o_orderkey, o_totalprice, CAST(calculated AS DOUBLE) AS calculated_total
FROM orders JOIN (SELECT l_orderkey, SUM({LINE_TOTAL}) AS calculated FROM lineitem GROUP BY l_orderkey)
  ON o_orderkey = l_orderkey
WHERE ABS(CAST(o_totalprice AS DECIMAL(12,2)) - calculated) > 0.01
""")
def j_total_mismatch(t):
    lines = t.lineitem.groupBy("l_orderkey").agg(F.sum(line_total()).alias("calculated"))
    off = F.abs(F.col("o_totalprice").cast("decimal(12,2)") - F.col("calculated")) > F.lit("0.01").cast("decimal(3,2)")
    return t.orders.join(lines, on("o_orderkey", "l_orderkey")).filter(off).select(
        "o_orderkey", "o_totalprice", F.col("calculated").cast("double").alias("calculated_total")
    )


@query("j_self_pairs", """
WITH d AS (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem)
SELECT a.l_partkey AS part_a, b.l_partkey AS part_b, COUNT(*) AS orders_together
FROM d a JOIN d b ON a.l_orderkey = b.l_orderkey AND a.l_partkey < b.l_partkey
GROUP BY a.l_partkey, b.l_partkey HAVING COUNT(*) >= 2
""")
def j_self_pairs(t):
    pairs = frequent_pairs(t.lineitem, "l_orderkey", "l_partkey", min_support=2)
    return pairs.toDF("part_a", "part_b", "orders_together")


@query("j_cross", """
SELECT r_name, p_partkey, p_name FROM region CROSS JOIN part
""")
def j_cross(t):
    return every_combination(t.part.select("p_partkey", "p_name"), t.region.select("r_name"))


@query("j_agg_back", f"""
SELECT o_orderkey, o_custkey, o_totalprice,
       COUNT(*) OVER w AS purchase_count, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) OVER w AS DOUBLE) AS total_spent,
       MAX(o_totalprice) OVER w AS max_purchase
FROM orders WINDOW w AS (PARTITION BY o_custkey)
""")
def j_agg_back(t):
    rows = t.orders.select("o_orderkey", "o_custkey", "o_totalprice")
    return back_to_rows(
        rows, ["o_custkey"],
        F.count(F.lit(1)).alias("purchase_count"), exact_sum("o_totalprice").alias("total_spent"),
        F.max("o_totalprice").alias("max_purchase"),
    )
