"""Projections, filters, conditionals."""

from pyspark.sql import functions as F

from quayside.functions import numbers as N
from quayside.functions.exact import line_total
from quayside.operators.columns import columns_like, numeric_columns
from quayside.queries.registry import query


@query("p_select_all", "SELECT * FROM customer")
def p_select_all(t):
    return t.customer.select("*")


@query("p_project", """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_date, o_totalprice, c_name
FROM orders JOIN customer ON o_custkey = c_custkey
WHERE o_orderdate >= DATE '1998-01-01'
""")
def p_project(t):
    recent = t.orders.filter(F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz"))
    return recent.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", F.col("o_orderdate").cast("date").alias("order_date"), "o_totalprice", "c_name"
    )


@query("p_eq", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'")
def p_eq(t):
    return t.orders.filter(F.col("o_orderstatus") == "F").select("o_orderkey", "o_custkey", "o_totalprice")


@query("p_date_range", """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_date, o_totalprice FROM orders
WHERE o_orderdate BETWEEN DATE '1997-07-01' AND DATE '1997-09-30' OR o_orderdate > DATE '2001-06-30'
""")
def p_date_range(t):
    day = lambda s: F.lit(s).cast("timestamp_ntz")
    c = F.col("o_orderdate")
    wanted = c.between(day("1997-07-01"), day("1997-09-30")) | (c > day("2001-06-30"))
    return t.orders.filter(wanted).select("o_orderkey", c.cast("date").alias("order_date"), "o_totalprice")


@query("p_in_and", """
SELECT c_custkey, c_name, n_name, c_mktsegment FROM customer JOIN nation ON c_nationkey = n_nationkey
WHERE n_name IN ('NATION_3', 'NATION_7') AND c_mktsegment = 'BUILDING' ORDER BY c_custkey DESC
""")
def p_in_and(t):
    cities = t.nation.filter(F.col("n_name").isin("NATION_3", "NATION_7"))
    return (
        t.customer.filter(F.col("c_mktsegment") == "BUILDING")
        .join(cities, F.col("c_nationkey") == F.col("n_nationkey"))
        .select("c_custkey", "c_name", "n_name", "c_mktsegment")
        .orderBy(F.col("c_custkey").desc())
    )


@query("p_like", "SELECT p_partkey, p_name FROM part WHERE p_name LIKE 's%'")
def p_like(t):
    return t.part.filter(F.col("p_name").like("s%")).select("p_partkey", "p_name")


@query("p_ilike", "SELECT p_partkey, p_name FROM part WHERE p_name ILIKE 'S%'")
def p_ilike(t):
    return t.part.filter(F.col("p_name").ilike("S%")).select("p_partkey", "p_name")


@query("p_revenue", """
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity * (l_extendedprice / l_quantity) AS gross_amount,
       l_extendedprice * CAST(l_quantity AS INTEGER) AS revenue
FROM lineitem
""")
def p_revenue(t):
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        (F.col("l_quantity") * (F.col("l_extendedprice") / F.col("l_quantity"))).alias("gross_amount"),
        N.revenue("l_extendedprice", "l_quantity").alias("revenue"),
    )


@query("p_discount_filter", """
SELECT l_orderkey, l_linenumber, UPPER(p_name) AS product, l_extendedprice * 0.9 AS discounted,
       l_extendedprice * l_quantity AS revenue
FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_extendedprice > 50000
""")
def p_discount_filter(t):
    high = t.lineitem.filter(F.col("l_extendedprice") > 50000)
    return high.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(
        "l_orderkey", "l_linenumber", F.upper("p_name").alias("product"),
        (F.col("l_extendedprice") * 0.9).alias("discounted"),
        (F.col("l_extendedprice") * F.col("l_quantity")).alias("revenue"),
    )


@query("p_price_tier", """
SELECT p_partkey, p_name, p_retailprice,
       CASE WHEN p_retailprice < 925 THEN 'Budget' WHEN p_retailprice < 950 THEN 'Mid-Range'
            WHEN p_retailprice < 975 THEN 'Premium' ELSE 'Luxury' END AS price_tier
FROM part
""")
def p_price_tier(t):
    tier = N.tiers("p_retailprice", [925, 950, 975], ["Budget", "Mid-Range", "Premium", "Luxury"])
    return t.part.select("p_partkey", "p_name", "p_retailprice", tier.alias("price_tier"))


@query("p_tier_discount", f"""
WITH o AS (
  SELECT o_orderkey, c_mktsegment AS tier, o_totalprice,
         CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 0.20 WHEN 'BUILDING' THEN 0.15
              WHEN 'FURNITURE' THEN 0.10 ELSE 0.05 END AS rate
  FROM orders JOIN customer ON o_custkey = c_custkey)
SELECT o_orderkey, tier, CAST(rate AS DOUBLE) AS discount,
       CAST(CAST(o_totalprice AS DECIMAL(12,2)) * (1 - CAST(rate AS DECIMAL(3,2))) AS DOUBLE) AS final_amount,
       CASE WHEN o_totalprice > 100000 THEN TRUE ELSE FALSE END AS needs_approval
FROM o
""")
def p_tier_discount(t):
    rates = {"AUTOMOBILE": 0.20, "BUILDING": 0.15, "FURNITURE": 0.10}
    rate = N.tier_discount("c_mktsegment", rates, 0.05)
    joined = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    return joined.select(
        "o_orderkey", F.col("c_mktsegment").alias("tier"), rate.alias("discount"),
        line_total("o_totalprice", rate).cast("double").alias("final_amount"),
        (F.col("o_totalprice") > 100000).alias("needs_approval"),
    )


@query("p_flags", """
SELECT c_custkey,
       CASE WHEN c_acctbal > 4000 AND c_nationkey >= 10 AND c_mktsegment <> 'MACHINERY' THEN 1 ELSE 0 END AS healthy,
       CASE WHEN c_acctbal < 0 OR c_mktsegment = 'HOUSEHOLD' THEN 1 ELSE 0 END AS watch,
       CASE WHEN c_acctbal >= 1000 THEN
              CASE WHEN c_nationkey >= 5 THEN
                     CASE WHEN c_mktsegment = 'BUILDING' THEN 'APPROVED' ELSE 'CONDITIONAL' END
                   ELSE 'REJECTED: region' END
            ELSE 'REJECTED: balance' END AS verdict
FROM customer
""")
def p_flags(t):
    bal, nation, seg = F.col("c_acctbal"), F.col("c_nationkey"), F.col("c_mktsegment")
    verdict = (
        F.when(bal < 1000, "REJECTED: balance")
        .when(nation < 5, "REJECTED: region")
        .when(seg == "BUILDING", "APPROVED")
        .otherwise("CONDITIONAL")
    )
    return t.customer.select(
        "c_custkey",
        ((bal > 4000) & (nation >= 10) & (seg != "MACHINERY")).cast("int").alias("healthy"),
        ((bal < 0) | (seg == "HOUSEHOLD")).cast("int").alias("watch"),
        verdict.alias("verdict"),
    )


@query("p_safe_div", """
SELECT l_orderkey, l_linenumber, l_extendedprice / NULLIF(l_discount, 0) AS price_per_discount,
       l_quantity / NULLIF(l_tax, 0) AS quantity_per_tax
FROM lineitem
""")
def p_safe_div(t):
    return t.lineitem.select(
        "l_orderkey", "l_linenumber",
        N.safe_divide("l_extendedprice", "l_discount").alias("price_per_discount"),
        N.safe_divide("l_quantity", "l_tax").alias("quantity_per_tax"),
    )


@query("p_numeric_columns", "SELECT c_custkey, c_nationkey, c_acctbal FROM customer")
def p_numeric_columns(t):
    return t.customer.select(*numeric_columns(t.customer))


@query("p_columns_like", "SELECT c_name FROM customer")
def p_columns_like(t):
    return t.customer.select(*columns_like(t.customer, "NAME"))
